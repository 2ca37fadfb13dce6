"""What compiled rules do to requests: the verdict of the last rule that matches.

Rules act in the order of their list.  ``ignore-previous-rules`` cancels what stands
before it in the same list, so a list's verdict on a request is the action of its last
matching rule.

Rules meet requests by equality alone.  Each rule is found by one kind of key:

* ``h`` the host of a rule for one host and all below it (nearly all rules): the suffixes of the request's host;
* ``g`` four characters that any address must have which the rule's expression matches, one of them by its hash
  but none that most addresses have, if that can be: the runs of four characters of the request's address;
* ``t`` the domains of a rule for any address on some sites: the suffixes of the top page's host;
* ``s`` nothing: such rules are tried on all requests, which are dealt over ``SALTS`` keys.

Only the pairs that meet are tried by expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievecraft import profile as fixed
from sievecraft.functions import columns as c

HOST_RULE = r"^\^\[htpsw\]\+://\(\[a-z0-9-\]\+\\\.\)\*([a-z0-9-]+(?:\\\.[a-z0-9-]+)*)\[/:&\?=,;\]$"
GRAM, SALTS = 4, 64
#: Runs that are in so many addresses that they tell little.
COMMON = ("http", "ttp:", "ttps", "tp:/", "tps:", "p://", "ps:/", "s://", "://w", "//ww", "/www", "www.", ".com", ".net", ".org", "com/", "net/", "org/", "html", "htm/")


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z]+://([^/?#:]+)", 1))


def _within(domains: Column, site: Column) -> Column:
    """Whether a site is one of ``*domain`` or below one."""
    return F.exists(domains, lambda d: F.when(d.startswith("*"), (site == F.substring(d, 2, 1 << 20)) | site.endswith(F.concat(F.lit("."), F.substring(d, 2, 1 << 20)))).otherwise(site == d))


def applies(trigger: Column, r: DataFrame) -> Column:
    """Whether a trigger's conditions other than its address hold; ``r``: type, party, context, method, top_url, frame_url of requests."""
    def given(name, test, negate=False):
        value = trigger[name]
        return value.isNull() | (~test(value) if negate else test(value))

    top, frame = r["top_url"], r["frame_url"]
    hits = lambda url: lambda rx: F.exists(rx, lambda x: F.rlike(F.lower(url), x))
    return (
        given("resource-type", lambda v: F.array_contains(v, r["type"])) & given("load-type", lambda v: F.array_contains(v, r["party"]))
        & given("load-context", lambda v: F.array_contains(v, r["context"])) & given("request-method", lambda v: v == r["method"])
        & given("if-domain", lambda v: _within(v, host(top))) & given("unless-domain", lambda v: _within(v, host(top)), True)
        & given("if-top-url", hits(top)) & given("unless-top-url", hits(top), True) & given("if-frame-url", hits(frame)) & given("unless-frame-url", hits(frame), True)
    )


def literals(rx: Column) -> Column:
    """Runs of characters that stand in any text that an expression matches, in lower case.

    Groups that may be missing go, others lose their parentheses, from the inside to the outside;
    classes, wildcards and what is repeated end a run.
    """
    out = F.regexp_replace(F.replace(rx, F.lit(fixed.ANCHOR), F.lit("\u0001")), r"\[(?:\\.|[^\]\\])*\](?:[*+?])?", "\u0001")
    out = F.regexp_replace(out, r"\\([^a-zA-Z0-9])", "$1\u0002")  # the sign after an escaped character keeps it from having a meaning
    for _ in range(5):
        out = F.regexp_replace(out, r"\((?!\u0002)([^()]*)\)(?!\u0002)[*?]", "\u0001")
        out = F.regexp_replace(out, r"\((?!\u0002)([^()]*)\)(?!\u0002)(?:\+)?", "\u0001$1\u0001")
    out = F.regexp_replace(out, r"(?s)(?:\\.|[^\u0002]\u0002|[^\u0002])[*?+](?!\u0002)", "\u0001")
    out = F.regexp_replace(out, r"[.^$()\\|](?!\u0002)", "\u0001")
    return F.split(F.lower(F.replace(out, F.lit("\u0002"), F.lit(""))), "\u0001")


def grams(text: Column) -> Column:
    """The distinct runs of four characters of a text."""
    n = F.length(text) - GRAM + 1
    return F.when(n > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(text, i, GRAM)))).otherwise(F.array().cast("array<string>"))


def _tops(domains: Column) -> Column:
    return F.transform(domains, lambda d: F.concat(F.lit("t"), F.ltrim(d, F.lit("*"))))


def keys_of(trigger: Column) -> Column:
    """The key, or the keys, by which a rule is found."""
    url, domains = trigger["url-filter"], trigger["if-domain"]
    site = F.replace(F.regexp_extract(url, HOST_RULE, 1), F.lit("\\."), F.lit("."))
    ordered = F.transform(F.flatten(F.transform(literals(url), grams)), lambda x: F.struct(x.isin(*COMMON).alias("common"), F.xxhash64(x).alias("hash"), x.alias("gram")))
    gram = F.array_min(ordered)["gram"]
    salts = F.transform(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda i: F.concat(F.lit("s"), i))
    found = F.coalesce(F.when(site != "", F.array(F.concat(F.lit("h"), site))), F.transform(F.array_compact(F.array(gram)), lambda x: F.concat(F.lit("g"), x)))
    return F.when(F.size(found) > 0, found).otherwise(F.coalesce(F.array_distinct(_tops(domains)), salts))


def matches(requests: DataFrame, rules: DataFrame) -> DataFrame:
    """(req_id, list_id, position, action, selector) of all rules that match; ``requests`` has req_id, url and the columns of ``applies``."""
    prefixed = lambda sign, values: F.transform(values, lambda x: F.concat(F.lit(sign), x))
    salt = F.array(F.concat(F.lit("s"), F.pmod(F.xxhash64("req_id"), F.lit(SALTS))))
    asked = requests.withColumn("_tops", prefixed("t", c.suffixes(host(F.col("top_url")))))
    asked = asked.withColumn("key", F.explode(F.array_distinct(F.concat(prefixed("h", c.suffixes(host(F.col("url")))), "_tops", prefixed("g", grams(F.lower(F.col("url")))), salt))))
    met = asked.join(rules.select("list_id", "position", "action", "selector", "trigger", F.explode(keys_of(F.col("trigger"))).alias("key")), "key")
    # The suffix of a host says the address matches, up to the separator, which any address has after its host.
    rx, kind = F.col("trigger")["url-filter"], F.substring("key", 1, 1)
    case = F.coalesce(F.col("trigger")["url-filter-is-case-sensitive"], F.lit(False))
    fits = F.when(kind == "h", True).when(rx == ".*", True).when(case, F.rlike("url", rx)).otherwise(F.rlike(F.lower("url"), F.lower(rx)))
    # A rule for several domains may meet a request by more than one of them; the longest counts.
    once = (kind != "t") | (F.get(F.array_intersect("_tops", _tops(F.col("trigger")["if-domain"])), F.lit(0)) == F.col("key"))
    return met.filter(once & fits & applies(F.col("trigger"), met)).select("req_id", "list_id", "position", "action", "selector")


def decide(requests: DataFrame, rules: DataFrame) -> DataFrame:
    """(req_id, blocked, by): blocked if the last matching rule of any list blocks; ``by`` is the first such list."""
    found = matches(requests, rules.filter("action IN ('block', 'ignore-previous-rules')"))
    verdict = found.groupBy("req_id", "list_id").agg(F.max_by("action", "position").alias("verdict"))
    blocked = verdict.filter("verdict = 'block'").groupBy("req_id").agg(F.min("list_id").alias("by"))
    return requests.select("req_id").join(blocked, "req_id", "left").select("req_id", F.col("by").isNotNull().alias("blocked"), "by")


def hidden_selectors(requests: DataFrame, rules: DataFrame) -> DataFrame:
    """(req_id, list_id, selector) of cosmetics that act on a page: those after the last matching exception that is not for documents alone."""
    found = matches(requests, rules.filter("action IN ('css-display-none', 'ignore-previous-rules')").filter((F.col("action") == "css-display-none") | F.col("trigger")["resource-type"].isNull()))
    lifted = F.max(F.when(F.col("action") == "ignore-previous-rules", F.col("position"))).over(W.partitionBy("req_id", "list_id"))
    shown = found.withColumn("lifted", lifted).filter("action = 'css-display-none'")
    return shown.filter(F.col("lifted").isNull() | (F.col("position") > F.col("lifted"))).select("req_id", "list_id", "selector")
