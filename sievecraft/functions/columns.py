"""Native column expressions: line shapes, the common pattern forms, and small scalar functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievecraft import profile as fixed
from sievecraft.profile import Profile

#: What str.strip() trims, as a Java class.
BLANK = r"[\s\x1c-\x1f\x85   -     　]"
PLAIN_HOST = r"^\|\|([a-z0-9][a-z0-9.-]*[a-z0-9])\^$"
#: The earliest marker with something after it (longer markers first, so the longest of one place).
COSMETIC = "(?s)^(.*?)(" + "|".join(re.escape(m) for m in sorted(fixed.MARKERS, key=len, reverse=True)) + ")(.+)$"


def strip(col: Column) -> Column:
    return F.regexp_replace(col, f"^{BLANK}+|{BLANK}+$", "")


def escape(col: Column) -> Column:
    """Every character with a meaning in expressions, escaped."""
    return F.regexp_replace(col, r"([.+?()\[\]{}|^$\\*])", r"\\$1")


def plain_filter(host: Column) -> Column:
    """The expression of ``||host^``, the form of most rules."""
    return F.concat(F.lit(fixed.ANCHOR), F.replace(host, F.lit("."), F.lit("\\.")), F.lit(fixed.SEP_FINAL))


def site_filter(domain: Column) -> Column:
    """``*site`` (with all below it) or ``site`` as an expression on addresses."""
    host = F.replace(F.ltrim(domain, F.lit("*")), F.lit("."), F.lit("\\."))
    return F.concat(F.when(domain.startswith("*"), F.lit(fixed.ANCHOR)).otherwise(F.lit(fixed.SITE)), host, F.lit(fixed.SEP_FINAL))


def frame_filter(domain: Column) -> Column:
    """The frame expression of a target domain ``*name``."""
    return F.concat(F.lit(fixed.ANCHOR), escape(F.substring(domain, 2, 1 << 20)), F.lit(fixed.SEP_FINAL))


def top_filter(domain: Column, path: Column) -> Column:
    """Host and path in one expression; no host stands for any."""
    head = F.when(domain == "", F.lit(fixed.ANY_HOST)).otherwise(F.concat(F.lit(fixed.ANCHOR), escape(domain)))
    return F.concat(head, escape(path))


def pattern_filter(pattern: Column) -> Column:
    """The expression of a pattern that is no regular expression; null where it can't be rendered."""
    core = F.regexp_replace(pattern, r"^\|{1,2}|(?<!\\)\|$", "")
    head = F.when(pattern.startswith("||"), F.lit(fixed.ANCHOR)).when(pattern.startswith("|"), F.lit("^")).otherwise(F.lit(""))
    tail = F.when(pattern.rlike(r"(?<!\\)\|$"), F.lit("$")).otherwise(F.lit(""))
    text = F.regexp_replace(core, r"([.+?()\[\]{}|$\\])", r"\\$1")
    text = F.regexp_replace(text, r"\*", ".*")
    text = F.regexp_replace(text, r"\^$", fixed.SEP_FINAL)
    text = F.regexp_replace(text, r"\^", re.sub(r"([\\$])", r"\\\1", "\u0001"))
    text = F.replace(text, F.lit("\u0001"), F.lit(fixed.SEP_INNER))
    whole = F.concat(head, text, tail)
    whole = F.regexp_replace(whole, r"^(?:\.\*(?!\$))+", "")
    bad = core.contains("|") | core.rlike(r"[{}]") | ~core.rlike(r"^[\x00-\x7F]*$")
    return F.when(pattern.isin("", "*", "|", "||"), F.lit(".*")).when(~bad, F.when(whole == "", F.lit(".*")).otherwise(whole))


def host_of(line: Column) -> Column:
    return F.lower(F.regexp_extract(line, fixed.HOSTS_LINE, 1))


def suffixes(host: Column) -> Column:
    """A host and all its parents."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def url_key(url: Column) -> Column:
    """An address without scheme, query, case and slashes at its end."""
    return F.rtrim(F.regexp_replace(F.split_part(F.lower(url), F.lit("?"), F.lit(1)), "^https?://", ""), F.lit("/"))


def dns_blackhole(value: Column) -> Column:
    """Whether a DNS answer means that the host is blocked."""
    return F.lower(value).rlike(fixed.DNS_BLACKHOLE)


def selector_fault(selector: Column, profile: Profile) -> Column:
    """Code of what is wrong with a selector; null if nothing is."""
    s, low = strip(selector), F.lower(selector)
    extended = F.lit(False)
    for token in fixed.EXTENDED_CSS:
        extended = extended | low.contains(token)
    return (
        F.when((s == "") | (F.length(s) > fixed.MAX_SELECTOR), "sel_length").when(s.rlike("[{}]"), "sel_style").when(extended, "sel_extended")
        .when(low.contains(":has(") & F.lit(not profile.allow_has), "sel_has_off").when(s.rlike(r"[\x00-\x1f]"), "sel_control")
    )


FORBIDDEN = "|".join(re.escape(t) for t in fixed.FORBIDDEN)


def misplaced_anchor(rx: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(rx, r"(?s)\\.", "a"), r"\[[^\]]*\]", "a")
    return F.substring(bare, 2, 1 << 20).contains("^") | bare.rlike(r"(?s)\$.")


def trigger_fault(trigger: Column, action: Column, profile: Profile) -> Column:
    """Code of why the target would refuse a rule; null if it would not."""
    url, get = trigger["url-filter"], lambda k: trigger[k]
    conditions = [get(k) for k in fixed.CONDITIONS]
    count = sum((c.isNotNull().cast("int") for c in conditions), F.lit(0))
    empty = lambda k: F.coalesce(F.size(get(k)) == 0, F.lit(False))
    hit = lambda k, f: F.coalesce(F.exists(get(k), f), F.lit(False))
    any_of = lambda keys, f: F.lit(False) if not keys else f(keys[0]) | any_of(keys[1:], f)
    domains, urls = [k for k in fixed.CONDITIONS if k.endswith("domain")], [k for k in fixed.CONDITIONS if k.endswith("url")]
    ascii_ = r"^[\x00-\x7F]*$"
    foreign = lambda k, allowed: hit(k, lambda x: ~x.isin(*allowed))
    return (
        F.when(F.coalesce(url, F.lit("")) == "", "val_no_filter").when(~url.rlike(ascii_), "val_filter_ascii").when(url.rlike(FORBIDDEN), "rx_subset")
        .when(misplaced_anchor(url), "rx_anchor").when(count > 1, "val_multi_cond").when(any_of(list(fixed.CONDITIONS), empty), "val_empty_cond")
        .when(any_of(domains, lambda k: hit(k, lambda x: (x != F.lower(x)) | ~x.rlike(ascii_))), "val_domain")
        .when(any_of(urls, lambda k: hit(k, lambda x: (x == "") | ~x.rlike(ascii_) | x.rlike(FORBIDDEN) | misplaced_anchor(x))), "val_cond_rx")
        .when(foreign("resource-type", profile.all_types), "val_type").when(foreign("load-type", ("first-party", "third-party")), "val_party")
        .when(foreign("load-context", ("top-frame", "child-frame")), "val_context")
        .when(~F.coalesce(get("request-method").isin(*sorted(fixed.METHODS)), F.lit(True)), "val_method").when(~action.isin(*fixed.ACTIONS), "val_action")
    )
