"""Operators over the driver's tables, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievecraft import profile as fixed
from sievecraft.functions import columns as c
from sievecraft.functions import grammar as g
from sievecraft.functions import translate
from sievecraft.operators import compile as cp
from sievecraft.operators import evaluate, output, overlap, validate
from sievecraft.plans import synthetic as syn
from sievecraft.profile import BUCKET, TRIGGER_DDL, Profile
from sievecraft.sources import catalogue as cat
from sievecraft.sources import lists

QUERIES: dict = {}
ORACLES: dict = {}


def query(oracle: str | None = None, name: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[name or f.__name__] = f
        if oracle is not None:
            ORACLES[name or f.__name__] = oracle
        return f

    return add


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


HEAD, END = _quoted(fixed.ANCHOR), _quoted(fixed.SEP_FINAL)
DUCK = syn.LINES
#: The expression of a host in SQL.
SITE = f"{HEAD} || replace(host, '.', '\\.') || {END}"


# ------------------------------------------------------------------ line shapes


@query(f"SELECT page_id, {SITE} AS url_filter FROM ({syn.PAGES}) p")
def fn02_plain_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syn.pages(spark, sf_dir).select("page_id", c.plain_filter(F.col("host")).alias("url_filter"))


PATTERN = "CASE page_id % 7 WHEN 0 THEN '||' || host || '/ad*^x' WHEN 1 THEN '|https://' || host || '|' WHEN 2 THEN '*banner^' WHEN 3 THEN host || '^' WHEN 4 THEN '/ad.' || CAST(page_id AS VARCHAR(9)) WHEN 5 THEN 'a|b' ELSE '*' END"
_ESC = "replace(host, '.', '\\.')"


@query(f"""SELECT page_id, CASE page_id % 7 WHEN 0 THEN {HEAD} || {_ESC} || '/ad.*{fixed.SEP_INNER}x' WHEN 1 THEN '^https://' || {_ESC} || '$' WHEN 2 THEN 'banner' || {END}
 WHEN 3 THEN {_ESC} || {END} WHEN 4 THEN '/ad\\.' || CAST(page_id AS VARCHAR(9)) WHEN 5 THEN NULL ELSE '.*' END AS url_filter FROM ({syn.PAGES}) p""")
def fn01_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = syn.pages(spark, sf_dir).withColumn("pattern", F.expr(syn.spark_text(PATTERN)))
    return rows.select("page_id", c.pattern_filter(F.col("pattern")).alias("url_filter"))


@query(f"SELECT page_id, replace({SITE}, {HEAD}, '{fixed.SITE}') AS one, {SITE} AS all_below, {HEAD} || {_ESC} || {END} AS frame FROM ({syn.PAGES}) p")
def fn12_site_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = F.concat(F.lit("*"), "host")
    return syn.pages(spark, sf_dir).select("page_id", c.site_filter(F.col("host")).alias("one"), c.site_filter(star).alias("all_below"), c.frame_filter(star).alias("frame"))


KIND = "CASE WHEN k = 3 THEN 'comment' WHEN k IN (2, 4, 8) THEN 'cosmetic' ELSE 'network' END"


@query(f"SELECT list_id, {KIND} AS kind, count(*) AS n FROM ({DUCK}) l GROUP BY ALL")
def p01_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cp.classify(syn.lines(spark, sf_dir)).groupBy("list_id", "kind").agg(F.count("*").alias("n"))


HOSTS_LINE = "CASE page_id % 5 WHEN 0 THEN '0.0.0.0 ' || host WHEN 1 THEN '127.0.0.1 localhost' WHEN 2 THEN '# note' WHEN 3 THEN host ELSE '0.0.0.0\t' || upper(host) || ' # x' END"


@query(f"""SELECT page_id AS line_no, CASE page_id % 5 WHEN 1 THEN 'loopback' WHEN 2 THEN 'comment' ELSE 'network' END AS kind,
 CASE WHEN page_id % 5 IN (0, 3, 4) THEN '||' || lower(host) || '^' WHEN page_id % 5 = 1 THEN '127.0.0.1 localhost' ELSE '# note' END AS text FROM ({syn.PAGES}) p""")
def p02_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = syn.pages(spark, sf_dir).select(F.lit("h").alias("list_id"), F.col("page_id").alias("line_no"), F.expr(syn.spark_text(HOSTS_LINE)).alias("raw"))
    return cp.classify(rows, spark.createDataFrame([("h", True)], "list_id string, hosts boolean")).select("line_no", "kind", "text")


@query(f"SELECT page_id % 4 AS list_id, page_id % 4 <> 2 AS hosts FROM ({syn.PAGES}) p GROUP BY ALL")
def src14_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("page_id") % 4 == 2, F.concat(F.lit("||"), "host", F.lit("^"))).otherwise(F.concat(F.lit("0.0.0.0 "), "host"))
    return cp.detect_hosts(syn.pages(spark, sf_dir).select((F.col("page_id") % 4).alias("list_id"), F.col("page_id").alias("line_no"), raw.alias("raw")))


@query(f"SELECT line_no, CASE WHEN k = 4 THEN '' ELSE host END AS domains, CASE WHEN k = 8 THEN '#@#' ELSE '##' END AS marker, CASE WHEN k = 4 THEN '.box' || CAST(line_no % 5 AS VARCHAR) ELSE '.ad-' || CAST(line_no % 7 AS VARCHAR) END AS body FROM ({DUCK}) l WHERE k IN (2, 4, 8)")
def p03_cosmetic_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cp.classify(syn.lines(spark, sf_dir)).filter("kind = 'cosmetic'").select("line_no", "domains", "marker", "body")


@query(f"SELECT line_no, CASE WHEN strpos(raw, '$') > 0 THEN string_split(raw, '$')[1] ELSE raw END AS pattern, CASE WHEN strpos(raw, '$') > 0 THEN string_split(raw, '$')[2] ELSE '' END AS options FROM ({DUCK}) l WHERE k NOT IN (2, 3, 4, 8)")
def p04_split_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cp.classify(syn.lines(spark, sf_dir)).filter("kind = 'network'").select("line_no", "text")
    read = cp.read_with(rows, ["text"], lambda t: dict(zip(("pattern", "options"), g.split_options(t), strict=True)), "pattern: string, options: string")
    return read.select("line_no", "got.*")


@query(f"""WITH m AS (SELECT line_no, unnest(string_split(string_split(raw, '$')[2], ',')) AS m FROM ({DUCK}) l WHERE strpos(raw, '$') > 0)
SELECT name, count(*) AS n FROM (SELECT split_part(m, '=', 1) AS name FROM m) x GROUP BY name""")
def p07_modifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    def names(text: str) -> dict:
        found = [m.name for m in g.modifiers(g.split_options(text)[1])]
        return {"names": [fixed.ALIASES.get(n, n) for n in found]}

    rows = cp.classify(syn.lines(spark, sf_dir)).filter("kind = 'network'").select("text")
    return cp.read_with(rows, ["text"], names, "names: array<string>").select(F.explode("got.names").alias("name")).groupBy("name").agg(F.count("*").alias("n"))


_TLDS = ", ".join(_quoted(t) for t in fixed.TLDS)


@query(f"SELECT n_nationkey, '*' || lower(replace(n_name, '_', '-')) || '.' || t AS domain FROM nation CROSS JOIN (SELECT unnest([{_TLDS}]) AS t) x")
def p10_tld_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    expand = F.udf(g.target_domains, "array<string>", useArrow=True)
    name = F.concat(F.lower(F.replace("n_name", F.lit("_"), F.lit("-"))), F.lit(".*"))
    return syn.sql(spark, sf_dir, "SELECT * FROM nation").select("n_nationkey", F.explode(expand(name)).alias("domain"))


_ALL = ", ".join(_quoted(t) for t in fixed.ALL_TYPES)


@query(f"""SELECT p_partkey, array_to_string(CASE p_size % 3 WHEN 0 THEN list_filter([{_ALL}], lambda x: x <> 'image' AND x <> 'script') WHEN 1 THEN ['image', 'fetch']
 ELSE list_filter([{_ALL}], lambda x: x <> 'ping') END, ',') AS types FROM part""")
def p11_type_complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = F.when(F.col("p_size") % 3 == 0, "~image,~script").when(F.col("p_size") % 3 == 1, "image,xhr").otherwise("~beacon")
    rows = syn.sql(spark, sf_dir, "SELECT * FROM part").select("p_partkey", F.concat(F.lit("||x.org^$"), options).alias("line"))
    read = cp.read_with(rows, ["line"], lambda t: {"types": translate.network(t, Profile())["rules"][0]["trigger"]["resource-type"]}, "types: array<string>")
    return read.select("p_partkey", F.array_join("got.types", ",").alias("types"))


@query(f"""SELECT page_id, i AS sub, CASE WHEN i = 0 THEN 'block' ELSE 'ignore-previous-rules' END AS action,
 CASE i WHEN 0 THEN 'banner' WHEN 1 THEN {SITE.replace(END, "'/.*banner'")} ELSE {SITE.replace(END, "'/.*/.*banner'")} END AS url_filter
 FROM ({syn.PAGES}) p CROSS JOIN (SELECT unnest([0, 1, 2]) AS i) x""")
def p14_denyallow(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = syn.pages(spark, sf_dir).select(F.col("page_id"), F.concat(F.lit("banner$denyallow="), "host").alias("line"))
    read = cp.read_with(rows, ["line"], lambda t: {"rules": translate.network(t, Profile())["rules"]}, f"rules: {cp.RULES_DDL}")
    return read.select("page_id", F.posexplode("got.rules").alias("sub", "r")).select("page_id", "sub", "r.action", F.col("r.trigger")["url-filter"].alias("url_filter"))


@query("SELECT c_custkey, c_custkey % 6 IN (0, 1, 2, 3) AS blackhole FROM customer")
def p18_dnsrewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.element_at(F.array(*map(F.lit, ("0.0.0.0", "NXDOMAIN;;", " Refused. ", "NOERROR;A;0.0.0.0", "1.2.3.4", "NOERROR;A;1.1.1.1"))), (F.col("c_custkey") % 6 + 1).cast("int"))
    return syn.sql(spark, sf_dir, "SELECT * FROM customer").select("c_custkey", c.dns_blackhole(value).alias("blackhole"))


SELECTOR = "CASE p_size % 6 WHEN 0 THEN '.a' || CAST(p_partkey AS VARCHAR(9)) WHEN 1 THEN 'div:has(> .x)' WHEN 2 THEN 'a:has-text(b)' WHEN 3 THEN 'a { b }' WHEN 4 THEN '  ' ELSE 'a:upward(2)' END"


@query("SELECT p_partkey, CASE p_size % 6 WHEN 2 THEN 'sel_extended' WHEN 3 THEN 'sel_style' WHEN 4 THEN 'sel_length' WHEN 5 THEN 'sel_extended' END AS fault FROM part")
def f03_selectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syn.sql(spark, sf_dir, "SELECT * FROM part").select("p_partkey", c.selector_fault(F.expr(syn.spark_text(SELECTOR)), Profile()).alias("fault"))


@query("SELECT p_partkey, p_size % 4 IN (1, 2) AS misplaced, p_size % 4 = 3 AS forbidden FROM part")
def f04_f05_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rx = F.element_at(F.array(*map(F.lit, (r"^a\^[^$]b$", "a^b", "a$b", "a|b"))), (F.col("p_size") % 4 + 1).cast("int"))
    return syn.sql(spark, sf_dir, "SELECT * FROM part").select("p_partkey", c.misplaced_anchor(rx).alias("misplaced"), rx.rlike(c.FORBIDDEN).alias("forbidden"))


# -------------------------------------------------------- what lines do to lines

KEPT = f"({DUCK.replace('AS line_no', 'AS line_no')}) l"


@query(f"SELECT l.list_id, l.line_no FROM {KEPT} WHERE k IN (0, 1, 5, 6, 9) AND NOT (k = 0 AND EXISTS (SELECT 1 FROM ({DUCK}) b WHERE b.k = 7 AND b.list_id = l.list_id AND b.host = l.host))")
def jn01_badfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cp.network_rows(cp.classify(syn.lines(spark, sf_dir)), Profile())
    return rows.filter("reason IS NULL").select("list_id", "line_no")


@query(f"""SELECT l.list_id, l.line_no, CASE k WHEN 2 THEN host END AS site FROM {KEPT} WHERE k = 4 OR k = 2 AND NOT EXISTS
 (SELECT 1 FROM ({DUCK}) b WHERE b.k = 8 AND b.list_id = l.list_id AND b.host = l.host AND b.line_no % 7 = l.line_no % 7)""")
def jn02_lifted_selectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cp.cosmetic_rows(cp.classify(syn.lines(spark, sf_dir)), Profile())
    return rows.filter("reason IS NULL").select("list_id", "line_no", F.ltrim(F.get(F.col("trigger")["if-domain"], F.lit(0)), F.lit("*")).alias("site"))


@query("SELECT n_nationkey, n_nationkey % 5 <> 0 AS kept FROM nation")
def jn03_lifted_everywhere(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = syn.sql(spark, sf_dir, "SELECT * FROM nation")
    own = nation.select(F.lit("l").alias("list_id"), F.col("n_nationkey").cast("long").alias("line_no"), F.concat(F.lit("##.n"), F.col("n_nationkey")).alias("raw"))
    lifted = nation.filter("n_nationkey % 5 = 0").select(F.lit("l").alias("list_id"), (F.col("n_nationkey") + 100).cast("long").alias("line_no"), F.concat(F.lit("#@#.n"), F.col("n_nationkey")).alias("raw"))
    rows = cp.cosmetic_rows(cp.classify(own.unionByName(lifted)), Profile()).filter("line_no < 100")
    return rows.select(F.col("line_no").cast("int").alias("n_nationkey"), F.col("reason").isNull().alias("kept"))


@query(f"""WITH l AS (SELECT DISTINCT host AS s FROM ({syn.PAGES}) p WHERE page_id % 9 = 0), h AS (SELECT DISTINCT host FROM ({syn.PAGES}) p)
SELECT host FROM h WHERE NOT EXISTS (SELECT 1 FROM l WHERE host = s OR host LIKE '%.' || s)""")
def jn04_specifichide(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = syn.pages(spark, sf_dir)
    raw = rows.select(F.lit("l").alias("list_id"), "page_id", F.explode(F.array(F.concat("host", F.lit("##.promo")), F.when(F.col("page_id") % 9 == 0, F.concat(F.lit("@@||"), "host", F.lit("^$specifichide"))))).alias("raw")).filter("raw IS NOT NULL")
    raw = raw.select("list_id", (F.col("page_id") * 2 + F.col("raw").startswith("@@").cast("int")).alias("line_no"), "raw")
    rules = cp.compile_lists(raw, Profile()).rules.filter(F.col("bucket") == BUCKET["specific_css"])
    return rules.select(F.regexp_replace(F.replace(F.col("trigger")["url-filter"], F.lit("\\."), F.lit(".")), r"^.*?\)\*|\[/:&\?=,;\]$", "").alias("host")).distinct()


@query(f"""WITH s AS (SELECT list_id, '.s' || CAST(page_id % 40 AS VARCHAR) AS sel, min(page_id) AS f FROM ({syn.PAGES}) p GROUP BY ALL),
n AS (SELECT *, (row_number() OVER (PARTITION BY list_id ORDER BY f) - 1) // 7 AS packet FROM s)
SELECT list_id, CAST(packet AS BIGINT) AS packet, string_agg(sel, ', ' ORDER BY f) AS css FROM n GROUP BY list_id, packet""")
def ag05_selector_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = syn.pages(spark, sf_dir).select("list_id", F.col("page_id").alias("line_no"), F.concat(F.lit("##.s"), F.col("page_id") % 40).alias("raw"))
    profile = Profile(css_group_size=7)
    return cp.compile_lists(rows, profile).rules.select("list_id", F.col("k3").alias("packet"), F.col("selector").alias("css"))


@query(f"SELECT list_id, count(DISTINCT page_id % 40) AS selectors, count(*) - count(DISTINCT page_id % 40) AS merged FROM ({syn.PAGES}) p GROUP BY list_id")
def ag04_selector_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = syn.pages(spark, sf_dir).select("list_id", F.col("page_id").alias("line_no"), F.concat(F.lit("##.s"), F.col("page_id") % 40).alias("raw"))
    merged = cp.merge_selectors(cp.cosmetic_rows(cp.classify(rows), Profile()))
    return merged.groupBy("list_id").agg(F.count("*").alias("selectors"), F.sum(F.col("copies") - 1).alias("merged"))


@query("SELECT user_id AS list_id, event_type AS rule, min(event_id) AS k1, count(*) AS copies FROM events GROUP BY ALL")
def w01_dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    zero = F.lit(0).cast("long")
    blank = F.struct(*[F.lit(None).alias(k) for k in fixed.TRIGGER_KEYS]).cast(TRIGGER_DDL).withField("`url-filter`", F.col("event_type"))
    rows = syn.sql(spark, sf_dir, "SELECT * FROM events").select(F.col("user_id").alias("list_id"), F.lit(2).alias("bucket"), F.col("event_id").alias("k1"), zero.alias("k2"), zero.alias("k3"), F.lit(False).alias("atomic"), blank.alias("trigger"), F.lit("block").alias("action"))
    return cp.keep_first(rows).select("list_id", F.col("trigger")["url-filter"].alias("rule"), "k1", "copies")


#: Rules of the synthetic lists by hand: (line, section) of what is left of each list.
_RULES = f"""base AS ({DUCK}),
gone AS (SELECT DISTINCT list_id, host FROM base WHERE k = 7),
net AS (SELECT list_id, line_no, CASE k WHEN 5 THEN 1 WHEN 9 THEN 8 ELSE 2 END AS bucket, k,
  CASE k WHEN 6 THEN {HEAD} || {_ESC} || '/img/' WHEN 5 THEN '.*' WHEN 9 THEN {HEAD} || {_ESC} || '/ok' || {END} ELSE {SITE} END AS uf, CASE WHEN k = 5 THEN host WHEN k = 6 THEN CAST(line_no % 3 AS VARCHAR) ELSE '' END AS extra
  FROM base WHERE k IN (0, 1, 5, 6, 9) AND NOT (k = 0 AND EXISTS (SELECT 1 FROM gone WHERE gone.list_id = base.list_id AND gone.host = base.host))),
once AS (SELECT list_id, bucket, min(line_no) AS k1, k, uf, extra FROM net GROUP BY list_id, bucket, k, uf, extra),
cos AS (SELECT list_id, min(line_no) AS k1, host, '.ad-' || CAST(line_no % 7 AS VARCHAR) AS sel FROM base b WHERE k = 2 AND NOT EXISTS
  (SELECT 1 FROM base x WHERE x.k = 8 AND x.list_id = b.list_id AND x.host = b.host AND x.line_no % 7 = b.line_no % 7) GROUP BY ALL),
box AS (SELECT list_id, min(line_no) AS k1, '.box' || CAST(line_no % 5 AS VARCHAR) AS sel FROM base WHERE k = 4 GROUP BY ALL),
rules AS (SELECT list_id, bucket, k1, uf AS url_filter, CASE WHEN bucket = 2 THEN 'block' ELSE 'ignore-previous-rules' END AS action, NULL AS selector FROM once
  UNION ALL SELECT list_id, 3, 0, '.*', 'ignore-previous-rules', NULL FROM once WHERE bucket = 2 GROUP BY list_id
  UNION ALL SELECT list_id, 7, min(k1), {SITE}, 'css-display-none', string_agg(sel, ', ' ORDER BY k1) FROM cos GROUP BY list_id, host
  UNION ALL SELECT list_id, 0, min(k1), '.*', 'css-display-none', string_agg(sel, ', ' ORDER BY k1) FROM box GROUP BY list_id)"""


def _compiled(spark: SparkSession, sf_dir: str, profile: Profile | None = None) -> cp.Compiled:
    return cp.compile_lists(syn.lines(spark, sf_dir), profile)


@query(f"WITH {_RULES} SELECT list_id, CAST(row_number() OVER (PARTITION BY list_id ORDER BY bucket, k1) AS BIGINT) AS position, url_filter, action, selector FROM rules")
def so01_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = cp.assemble(_compiled(spark, sf_dir).rules)
    return rules.select("list_id", "position", F.col("trigger")["url-filter"].alias("url_filter"), "action", "selector")


@query(f"""WITH {_RULES}, p AS (SELECT *, row_number() OVER (PARTITION BY list_id ORDER BY bucket, k1) - 1 AS at, CAST(sum(CASE WHEN bucket >= 8 THEN 1 ELSE 0 END) OVER (PARTITION BY list_id) AS BIGINT) AS tail,
 count(*) OVER (PARTITION BY list_id) AS n, CAST(sum(CASE WHEN bucket <= 1 THEN 1 ELSE 0 END) OVER (PARTITION BY list_id) AS BIGINT) AS head FROM rules)
SELECT list_id, count(*) AS n FROM p GROUP BY list_id""", "so02_sizes")
def so02_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compiled(spark, sf_dir).rules.groupBy("list_id").agg(F.count("*").alias("n"))


@query("""WITH r AS (SELECT l_returnflag AS list_id, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber) - 1 AS place FROM lineitem)
SELECT list_id, CAST(place // 1000 + 1 AS INTEGER) AS chunk, count(*) AS n FROM r GROUP BY ALL""")
def so03_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = syn.sql(spark, sf_dir, "SELECT * FROM lineitem").select(F.col("l_returnflag").alias("list_id"), F.lit(2).alias("bucket"), F.col("l_orderkey").alias("k1"), F.col("l_linenumber").cast("long").alias("k2"), F.lit(0).cast("long").alias("k3"), F.lit(False).alias("atomic"))
    return output.chunks(rows, 1000).groupBy("list_id", "chunk").agg(F.count("*").alias("n"))


_PARTS = """r AS (SELECT l_returnflag AS list_id, l_orderkey AS k1, CASE WHEN l_orderkey % 50 = 0 THEN 8 ELSE 2 END AS bucket, l_linenumber AS k2, l_orderkey % 3 = 0 AS atomic FROM lineitem),
o AS (SELECT *, row_number() OVER (PARTITION BY list_id ORDER BY bucket, k1, k2) - 1 AS spot FROM r),
z AS (SELECT list_id, count(*) FILTER (WHERE bucket = 2) AS body, count(*) FILTER (WHERE bucket = 8) AS tail FROM o GROUP BY list_id),
g AS (SELECT list_id, min(spot) AS start, count(*) AS n FROM o WHERE atomic AND bucket = 2 GROUP BY list_id, k1),
c AS (SELECT list_id, 0::BIGINT AS spot, body, 3000 - tail AS room FROM z WHERE body + tail > 3000
 UNION ALL SELECT c.list_id, coalesce((SELECT max(greatest(g.start, c.spot + 1)) FROM g WHERE g.list_id = c.list_id AND g.start < c.spot + c.room AND c.spot + c.room < g.start + g.n), c.spot + c.room), body, room FROM c WHERE c.spot + c.room < body),
u AS (SELECT o.list_id, CASE WHEN bucket = 2 THEN (SELECT count(*) FROM c WHERE c.list_id = o.list_id AND c.spot <= o.spot AND c.spot > 0) + 1 END AS chunk, bucket FROM o),
m AS (SELECT z.list_id, (SELECT count(*) FROM c WHERE c.list_id = z.list_id AND c.spot > 0) + 1 AS chunks, tail FROM z)"""


@query(f"""WITH RECURSIVE {_PARTS} SELECT m.list_id, CAST(x.chunk AS INTEGER) AS chunk, CAST(x.n + m.tail AS BIGINT) AS n, m.tail AS tail
 FROM m JOIN (SELECT list_id, chunk, count(*) AS n FROM u WHERE bucket = 2 GROUP BY ALL) x USING (list_id)""")
def so03_tail_and_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every third order stand together, those of every fiftieth at the end of each file; 3,000 lines a file.

    A list with 3,000 lines or more for the end of each file has no files: its one row has all its lines and no chunk.  The SQL has no result then.
    """
    rows = syn.sql(spark, sf_dir, "SELECT * FROM lineitem").select(F.col("l_returnflag").alias("list_id"), F.when(F.col("l_orderkey") % 50 == 0, BUCKET["exception"]).otherwise(BUCKET["block"]).alias("bucket"), F.col("l_orderkey").alias("k1"), F.col("l_linenumber").cast("long").alias("k2"), F.lit(0).cast("long").alias("k3"), (F.col("l_orderkey") % 3 == 0).alias("atomic"))
    placed = output.chunks(rows.withColumn("atomic", F.col("atomic") & (F.col("bucket") == BUCKET["block"])), 3000, least=1)
    return placed.groupBy("list_id", "chunk").agg(F.count("*").alias("n"), F.count_if(F.col("bucket") == BUCKET["exception"]).alias("tail"))


@query("""WITH r AS (SELECT l_returnflag AS list_id, l_orderkey, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber) AS at FROM lineitem)
SELECT list_id, count(*) AS n, count(DISTINCT l_orderkey) AS groups_, 0 AS cut_groups FROM r GROUP BY ALL""")
def so04_atomic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order are atomic: how many orders are cut, whatever the size of files."""
    rows = syn.sql(spark, sf_dir, "SELECT * FROM lineitem").select(F.col("l_returnflag").alias("list_id"), F.lit(2).alias("bucket"), F.col("l_orderkey").alias("k1"), F.col("l_linenumber").cast("long").alias("k2"), F.lit(0).cast("long").alias("k3"), F.lit(True).alias("atomic"))
    spread = output.chunks(rows, 1000).groupBy("list_id", "k1").agg(F.count("*").alias("n"), (F.min("chunk") < F.max("chunk")).alias("cut"))
    return spread.groupBy("list_id").agg(F.sum("n").alias("n"), F.count("*").alias("groups_"), F.count_if("cut").cast("int").alias("cut_groups"))


# ----------------------------------------------------------------------- reports

_REASON = "CASE WHEN k = 7 THEN 'badfilter_directive' WHEN k = 10 THEN 'mod_unsupported:csp' WHEN k = 11 THEN 'mod_unknown:unheard' WHEN k = 0 AND gone THEN 'badfilter_retracted' WHEN k = 2 AND lifted THEN 'cos_excepted_all' END"
_LINES = f"""base AS ({DUCK}), marked AS (SELECT *, EXISTS (SELECT 1 FROM base x WHERE x.k = 7 AND x.list_id = b.list_id AND x.host = b.host) AS gone,
 EXISTS (SELECT 1 FROM base x WHERE x.k = 8 AND x.list_id = b.list_id AND x.host = b.host AND x.line_no % 7 = b.line_no % 7) AS lifted FROM base b),
why AS (SELECT *, {_REASON} AS reason FROM marked)"""


@query(f"WITH {_LINES} SELECT list_id, reason, count(*) AS n FROM why WHERE reason IS NOT NULL GROUP BY ALL")
def ag01_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return output.reasons(_compiled(spark, sf_dir).lines)


@query(f"WITH {_LINES} SELECT reason, count(*) AS n FROM why WHERE reason IS NOT NULL GROUP BY ALL")
def ag08_top_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return output.top_reasons(_compiled(spark, sf_dir).lines)


_COUNTS = f"""{_RULES}, {_LINES.replace('base AS', 'base2 AS').replace('FROM base x', 'FROM base2 x').replace('FROM base b', 'FROM base2 b')},
conv AS (SELECT list_id, sum(n) AS converted FROM (SELECT list_id, count(*) AS n FROM once GROUP BY list_id UNION ALL SELECT list_id, count(*) FROM cos GROUP BY list_id UNION ALL SELECT list_id, count(*) FROM box GROUP BY list_id) x GROUP BY list_id),
cnt AS (SELECT list_id, count(*) AS lines_total, count(*) FILTER (WHERE k <> 3) AS rules_in, count(*) FILTER (WHERE k = 3) AS comments, count(*) FILTER (WHERE reason IS NOT NULL) AS skipped FROM why GROUP BY list_id)"""
_COVER = "CASE WHEN rules_in > 0 THEN round_even(100.0 * coalesce(converted, 0) / rules_in, 2) ELSE 0 END"


@query(f"WITH {_COUNTS} SELECT list_id, lines_total, rules_in, comments, skipped, CAST(coalesce(converted, 0) AS BIGINT) AS converted, CAST({_COVER} AS DOUBLE) AS coverage_pct FROM cnt LEFT JOIN conv USING (list_id)")
def ag02_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return output.counts(_compiled(spark, sf_dir))


_SECTIONS = ", ".join(f"count(*) FILTER (WHERE bucket = {i}) AS {name}" for name, i in BUCKET.items())


@query(f"WITH {_RULES} SELECT list_id, count(*) AS rules_out, {_SECTIONS} FROM rules GROUP BY list_id")
def ag03_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return output.breakdown(_compiled(spark, sf_dir).rules)


_REPORT = f"{_COUNTS}, outs AS (SELECT list_id, count(*) AS rules_out FROM rules GROUP BY list_id), rep AS (SELECT *, rules_out > 0 AND (rules_in < 100 OR rules_out >= greatest(10, floor(rules_in * 0.5))) AS published FROM cnt LEFT JOIN outs USING (list_id))"


@query(f"WITH {_REPORT} SELECT list_id, rules_in, rules_out, published FROM rep")
def f09_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return output.report(_compiled(spark, sf_dir), Profile(min_yield=0.5)).select("list_id", "rules_in", "rules_out", "published")


@query(f"""WITH {_REPORT} SELECT count(*) AS lists, count(*) FILTER (WHERE published) AS lists_published, CAST(sum(rules_in) AS BIGINT) AS rules_in, CAST(sum(rules_out) AS BIGINT) AS rules_out,
 CAST(coalesce(sum(rules_in) FILTER (WHERE published), 0) AS BIGINT) AS published_in, CAST(coalesce(sum(rules_out) FILTER (WHERE published), 0) AS BIGINT) AS published_out, CAST(sum(skipped) AS BIGINT) AS skipped FROM rep""")
def ag06_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return output.totals(output.report(_compiled(spark, sf_dir), Profile(min_yield=0.5)))


@query(f"""WITH {_RULES}, x AS (SELECT list_id, count(*) AS e FROM base WHERE k IN (8, 10) GROUP BY list_id)
SELECT list_id, CAST(count(*) FILTER (WHERE bucket IN (2, 4)) AS BIGINT) AS network, CAST(count(*) FILTER (WHERE bucket IN (0, 7)) AS BIGINT) AS cosmetic, CAST(count(*) FILTER (WHERE bucket = 5) AS BIGINT) AS cookies,
 CAST(count(*) FILTER (WHERE bucket IN (1, 6, 8, 9)) AS BIGINT) AS exceptions, CAST(coalesce(max(e), 0) AS BIGINT) AS extended FROM rules LEFT JOIN x USING (list_id) GROUP BY list_id""")
def ag07_capabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return output.capabilities(output.report(_compiled(spark, sf_dir)))


@query(f"SELECT list_id, CASE k WHEN 8 THEN 'procedural' ELSE 'csp' END AS family, count(*) AS n FROM ({DUCK}) l WHERE k IN (8, 10) GROUP BY ALL")
def ag13_side_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return output.annex_counts(_compiled(spark, sf_dir).annex)


_PROCEDURAL = """'procedural:{"domains":["' || host || '"],"exception":true,"selector":".ad-' || CAST(line_no % 7 AS VARCHAR) || '"}'"""
_CSP = """'csp:{"domains":[],"url":"' || replace(replace(url_js, '\\', '\\\\'), '"', '\\"') || '","policy":"x"}'"""


@query(f"""WITH e AS (SELECT list_id, line_no, k, host, {_quoted(fixed.JS_ANCHOR)} || replace(host, '.', '\\.') || {_quoted(fixed.JS_SEPARATOR)} AS url_js FROM ({DUCK}) l WHERE k IN (8, 10))
SELECT list_id, sha256(string_agg(digest, '' ORDER BY b)) AS digest FROM (SELECT list_id, b, sha256(string_agg(j || chr(10), '' ORDER BY line_no)) AS digest FROM
 (SELECT list_id, line_no, CASE k WHEN 8 THEN {_PROCEDURAL} ELSE {_CSP} END AS j, (row_number() OVER (PARTITION BY list_id ORDER BY line_no) - 1) // 65536 AS b FROM e) x GROUP BY list_id, b) y GROUP BY list_id""")
def snk03_side_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return output.annex_digest(_compiled(spark, sf_dir).annex)


_JS = "replace(url_filter, '\\', '\\\\')"
_MORE = f"""CASE WHEN bucket = 3 THEN ',"resource-type":["document"],"load-context":["top-frame"]' WHEN bucket = 1 THEN ',"if-top-url":["' || replace({SITE.replace('host', 'extra')}, '\\', '\\\\') || '"]'
 WHEN k = 1 THEN ',"resource-type":["script"],"load-type":["third-party"]' WHEN k = 6 THEN ',"resource-type":["image"],"if-domain":["*site' || extra || '.org"]' WHEN k = 9 THEN ',"resource-type":["script"]' ELSE '' END"""


@query(f"""WITH {_RULES}, r AS (SELECT list_id, bucket, k1, k, uf AS url_filter, extra, CASE WHEN bucket = 2 THEN 'block' ELSE 'ignore-previous-rules' END AS action, NULL AS selector FROM once
  UNION ALL SELECT list_id, bucket, k1, -1, url_filter, '', action, selector FROM rules WHERE bucket IN (0, 3, 7))
SELECT list_id, bucket, k1, '{{"trigger":{{"url-filter":"' || {_JS} || '"' || {_MORE} || '}},"action":{{"type":"' || action || '"' || coalesce(',"selector":"' || selector || '"', '') || '}}}}' AS json FROM r""")
def snk01_rule_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compiled(spark, sf_dir).rules.select("list_id", "bucket", "k1", output.rule_json().alias("json"))


@query(f"WITH {_RULES} SELECT DISTINCT list_id, url_filter FROM rules WHERE action = 'block'")
def ag09_block_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.block_filters(_compiled(spark, sf_dir).rules)


@query(f"""WITH {_RULES}, f AS (SELECT DISTINCT list_id, url_filter FROM rules WHERE action = 'block'), s AS (SELECT list_id, count(*) AS size FROM f GROUP BY list_id)
SELECT x.list_id AS a, y.list_id AS b, count(*) AS shared, any_value(size) AS size, CAST(round_even(100.0 * count(*) / any_value(size), 0) AS INTEGER) AS pct
FROM f x JOIN f y USING (url_filter) JOIN s ON s.list_id = x.list_id WHERE x.list_id <> y.list_id GROUP BY ALL""")
def jn06_compiled_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.pairs(overlap.block_filters(_compiled(spark, sf_dir).rules))


@query(f"""WITH {_REPORT}, c AS (SELECT *, CAST({_COVER} AS DOUBLE) AS coverage FROM rep LEFT JOIN conv USING (list_id))
SELECT list_id, published, rules_in, rules_out, coverage AS coverage_pct, (SELECT count(*) FROM rep WHERE published) AS lists_published, (SELECT CAST(sum(rules_out) AS BIGINT) FROM rep) AS all_out, (SELECT count(*) FROM rep) AS lists_total FROM c""", "snk05_catalogue")
def snk05_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = output.catalogue_json(output.report(_compiled(spark, sf_dir), Profile(min_yield=0.5)))
    one = "array<struct<list_id: string, rules_in: bigint, rules_out: bigint, coverage_pct: double>>"
    read = made.select(F.from_json("json", f"totals struct<lists_published: bigint, rules_out: bigint>, lists_total bigint, lists {one}, unpublished {one}").alias("j")).select("j.*")
    of = lambda name, shown: read.select(F.explode(name).alias("l"), F.lit(shown).alias("published"), F.col("totals.lists_published").alias("lists_published"), F.col("totals.rules_out").alias("all_out"), "lists_total")
    return of("lists", True).unionByName(of("unpublished", False)).select("l.*", "published", "lists_published", "all_out", "lists_total")


# ----------------------------------------------------------- overlap, evaluation

_FILTERS = "SELECT DISTINCT source AS list_id, lang || CAST(n_chars % 60 AS VARCHAR) AS url_filter FROM documents"
_PAIRS = f"""WITH f AS ({_FILTERS}), s AS (SELECT list_id, count(*) AS size FROM f GROUP BY list_id),
p AS (SELECT x.list_id AS a, y.list_id AS b, count(*) AS shared FROM f x JOIN f y USING (url_filter) WHERE x.list_id <> y.list_id GROUP BY ALL),
r AS (SELECT a, b, shared, size, CAST(round_even(100.0 * shared / size, 0) AS INTEGER) AS pct FROM p JOIN s ON a = s.list_id)"""


def _filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syn.sql(spark, sf_dir, "SELECT * FROM documents").select(F.col("source").alias("list_id"), F.concat("lang", (F.col("n_chars") % 60).cast("string")).alias("url_filter")).distinct()


@query(f"{_PAIRS} SELECT * FROM r")
def jn06_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.pairs(_filters(spark, sf_dir))


@query(f"{_PAIRS} SELECT a, b, shared, size, pct, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY a ORDER BY pct DESC, b) AS INTEGER) AS rank FROM r WHERE pct >= 30) x WHERE rank <= 3")
def w07_top_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.coverage(_filters(spark, sf_dir), threshold=30)


@query(f"{_PAIRS} SELECT source AS id, coalesce(string_agg(b || ':' || CAST(pct AS VARCHAR), ',' ORDER BY rank), '') AS covered FROM (SELECT DISTINCT source FROM documents) d LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY pct DESC, b) AS rank FROM r WHERE pct >= 30) x WHERE rank <= 3) t ON a = source GROUP BY source")
def jn07_annotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = syn.sql(spark, sf_dir, "SELECT * FROM documents").select(F.col("source").alias("id")).distinct()
    made = overlap.annotate(ids, overlap.coverage(_filters(spark, sf_dir), threshold=30))
    return made.select("id", F.coalesce(F.array_join(F.transform("covered_by", lambda x: F.concat(x["id"], F.lit(":"), x["pct"])), ","), F.lit("")).alias("covered"))


@query(f"""WITH {_RULES}, q AS (SELECT page_id, host FROM ({syn.PAGES}) p),
m AS (SELECT q.page_id, b.list_id FROM q JOIN (SELECT DISTINCT list_id, b2.host FROM base b2 WHERE k = 1 OR (k = 0 AND NOT EXISTS (SELECT 1 FROM gone WHERE gone.list_id = b2.list_id AND gone.host = b2.host))) b ON q.host = b.host OR q.host LIKE '%.' || b.host)
SELECT page_id AS req_id, count(list_id) > 0 AS blocked, min(list_id) AS by FROM q LEFT JOIN m USING (page_id) GROUP BY page_id""")
def ev01_decide(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = cp.assemble(_compiled(spark, sf_dir).rules)
    return evaluate.decide(syn.requests(spark, sf_dir), rules)


@query(f"""WITH {_RULES} SELECT p.page_id AS req_id, c.list_id, count(*) AS n FROM ({syn.PAGES}) p JOIN (SELECT DISTINCT list_id, host AS site FROM cos) c ON p.host = c.site OR p.host LIKE '%.' || c.site GROUP BY ALL""")
def ev02_hidden_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = cp.assemble(_compiled(spark, sf_dir).rules).filter(F.col("bucket") == BUCKET["specific_css"])
    return evaluate.hidden_selectors(syn.requests(spark, sf_dir), rules).groupBy("req_id", "list_id").agg(F.count("*").alias("n"))


_BAD = [("url-filter", "a|b", "rx_subset"), ("url-filter", "a^b", "rx_anchor"), ("url-filter", "é", "val_filter_ascii"), ("request-method", "jump", "val_method")]


@query("SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'rx_subset' WHEN 1 THEN 'rx_anchor' WHEN 2 THEN 'val_filter_ascii' WHEN 3 THEN 'val_method' WHEN 4 THEN 'val_multi_cond' END AS fault FROM part")
def f01_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_size") % 6
    trigger = F.struct(*[F.lit(None).alias(k) for k in fixed.TRIGGER_KEYS]).cast(TRIGGER_DDL)
    url = F.when(n == 0, "a|b").when(n == 1, "a^b").when(n == 2, "é").otherwise("ok")
    trigger = trigger.withField("`url-filter`", url).withField("`request-method`", F.when(n == 3, "jump")).withField("`if-domain`", F.when(n == 4, F.array(F.lit("*a")))).withField("`unless-domain`", F.when(n == 4, F.array(F.lit("*b"))))
    return syn.sql(spark, sf_dir, "SELECT * FROM part").select("p_partkey", c.trigger_fault(trigger, F.lit("block"), Profile()).alias("fault"))


@query("SELECT CASE p_size % 4 WHEN 0 THEN 'rx_subset' WHEN 1 THEN 'val_key' ELSE 'val_action' END AS fault, count(*) AS n FROM part WHERE p_size % 4 <> 3 GROUP BY ALL")
def f02_file_validator(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_size") % 4
    j = F.when(n == 0, '{"trigger":{"url-filter":"a|b"},"action":{"type":"block"}}').when(n == 1, '{"trigger":{"url-filter":"a","odd":1},"action":{"type":"block"}}')
    j = j.when(n == 2, '{"trigger":{"url-filter":"a"},"action":{"type":"jump"}}').otherwise('{"trigger":{"url-filter":"a"},"action":{"type":"block"}}')
    files = syn.sql(spark, sf_dir, "SELECT * FROM part").groupBy(F.col("p_brand").alias("file")).agg(F.concat(F.lit("["), F.array_join(F.collect_list(j), ","), F.lit("]")).alias("content"))
    return validate.histogram(validate.faults(validate.parse_files(files)))


# ----------------------------------------------------------------------- sources


@query("""WITH l AS (SELECT o_orderpriority AS list_id, o_custkey % 10 AS h, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS n FROM orders)
SELECT list_id, avg(CASE WHEN h < 6 OR n > 300 THEN 1 ELSE 0 END) FILTER (WHERE n <= 300) >= 0.6 AS hosts FROM l GROUP BY list_id""")
def w03_first_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of thousands of lines, of which the first 300 tell the dialect; comments are no lines."""
    rows = syn.sql(spark, sf_dir, "SELECT * FROM orders").select(F.col("o_orderpriority").alias("list_id"), (F.col("o_orderkey") * 2).alias("line_no"), F.when(F.col("o_custkey") % 10 < 6, F.concat(F.lit("0.0.0.0 h"), "o_custkey", F.lit(".net"))).otherwise(F.concat(F.lit("||h"), "o_custkey", F.lit("^"))).alias("raw"))
    notes = rows.select("list_id", (F.col("line_no") + 1).alias("line_no"), F.lit("# a note").alias("raw"))
    return cp.detect_hosts(rows.unionByName(notes))


@query("SELECT page_id, rtrim(regexp_replace(split_part(lower(url), '?', 1), '^https?://', ''), '/') AS url_key FROM pages")
def src03_url_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syn.sql(spark, sf_dir, "SELECT * FROM pages").select("page_id", c.url_key(F.col("url")).alias("url_key"))


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syn.sql(spark, sf_dir, "SELECT * FROM documents").select(F.col("doc_id").alias("list_id"), F.col("text").alias("content"))


_ENDS = "[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e]"


@query("SELECT doc_id AS list_id, CAST(len(string_split(rtrim_one, chr(10))) AS BIGINT) AS n FROM (SELECT doc_id, regexp_replace(text, '\\n$', '') AS rtrim_one FROM documents WHERE text <> '') d")
def src12_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.split_lines(_texts(spark, sf_dir)).groupBy("list_id").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT source AS list_id, x.key, CASE x.key WHEN 'title' THEN 'List ' || source WHEN 'expires' THEN '4 days' END AS value FROM documents CROSS JOIN (SELECT unnest(['title', 'expires']) AS key) x")
def src11_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = syn.sql(spark, sf_dir, "SELECT * FROM documents").select(F.col("source").alias("list_id")).distinct()
    text = F.concat(F.lit("[Adblock Plus]\n! Title: List "), "list_id", F.lit("\n\n! Expires: 4 days\n! Title: other\n||a.com^\n! Late: no\n"))
    return lists.headers(lists.split_lines(names.select("list_id", text.alias("content"))))


@query("SELECT DISTINCT source AS list_id, 3 AS kept, 2 AS dropped FROM documents")
def src09_preprocessor(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = syn.sql(spark, sf_dir, "SELECT * FROM documents").select(F.col("source").alias("list_id")).distinct()
    text = "a\n!#if env_chromium\nb\n! note\n!#if adguard\nc\n!#endif\n!#else\nd\n!#endif\ne"
    rows = lists.preprocess(lists.split_lines(names.select("list_id", F.lit(text).alias("content"))))
    return rows.groupBy("list_id").agg(F.count("*").cast("int").alias("kept"), F.max("dropped").cast("int").alias("dropped"))


@query("SELECT DISTINCT source AS list_id, 'a,! begin include https://h.org/x.txt,b,! begin include https://h.org/y.txt,c,! end include https://h.org/y.txt,! not included: x.txt,! end include https://h.org/x.txt,d,! not included: https://other.org/z.txt' AS body FROM documents")
def src08_includes(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = syn.sql(spark, sf_dir, "SELECT * FROM documents").select(F.col("source").alias("list_id")).distinct()
    rows = lists.split_lines(names.select("list_id", F.lit("a\n!#include x.txt\nd\n!#include https://other.org/z.txt").alias("content")))
    library = spark.createDataFrame([("https://h.org/x.txt", "b\n!#include y.txt\n!#include x.txt"), ("https://h.org/y.txt", "c"), ("https://other.org/z.txt", "no")], "url string, content string")
    whole = lists.resolve_includes(rows, names.select("list_id", F.lit("https://h.org/list.txt").alias("url")), library)
    return whole.groupBy("list_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "raw"))), lambda x: x["raw"]), ",").alias("body"))


_DIGEST = """d AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
w AS (SELECT doc_id, s, n, (row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1) // 65536 AS b FROM d WHERE NOT regexp_matches(trim(s), '^$|^[!#\\[]')),
v AS (SELECT doc_id, b, count(*) AS rules, sha256(string_agg(trim(s) || chr(10), '' ORDER BY n)) AS digest FROM w GROUP BY doc_id, b),
g AS (SELECT doc_id, CAST(sum(rules) AS BIGINT) AS rules, sha256(string_agg(digest, '' ORDER BY b)) AS digest FROM v GROUP BY doc_id)"""


@query(f"WITH {_DIGEST} SELECT doc_id AS list_id, rules, digest FROM g")
def ag11_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.content_digest(lists.split_lines(_texts(spark, sf_dir)))


@query(f"WITH {_DIGEST} SELECT doc_id AS list_id, CASE WHEN f <> doc_id THEN f END AS duplicate_of FROM (SELECT doc_id, first_value(doc_id) OVER (PARTITION BY digest ORDER BY doc_id) AS f FROM g) x")
def w02_duplicate_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _texts(spark, sf_dir)
    return lists.mark_duplicates(lists.content_digest(lists.split_lines(texts)), texts.select("list_id", F.col("list_id").alias("pos"))).select("list_id", "duplicate_of")


def _catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups are regions, lists are nations; every fifth one is off, every seventh repeats an address, every eleventh an id."""
    rows = syn.sql(spark, sf_dir, "SELECT n_nationkey, n_name, r_regionkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
    k = F.col("n_nationkey")
    given = {"id": F.when(k % 11 == 10, F.lit("n1")).otherwise(F.concat(F.lit("n"), k)), "name": F.col("n_name"), "url": F.when(k % 7 == 6, F.lit("HTTPS://l.org/n2.txt/?v=1")).when(k % 2 == 0, F.concat(F.lit("https://l.org/n"), k, F.lit(".txt"))), "file": F.concat(F.lit("f"), k, F.lit(".txt")), "enabled": k % 5 != 4}
    kind = T_LIST
    item = F.struct(*[given.get(f, F.lit(None)).alias(f) for f in kind]).cast(cat.LIST_DDL)
    groups = rows.groupBy("r_regionkey", "r_name").agg(F.transform(F.array_sort(F.collect_list(F.struct(k.alias("k"), item.alias("l")))), lambda x: x["l"]).alias("lists"))
    group = F.struct(F.concat(F.lit("g"), "r_regionkey").alias("id"), F.col("r_name").alias("maintainer"), F.lit("https://h").alias("homepage"), F.lit("https://base.org/").alias("base"), F.lit(None).alias("enabled"), "lists").cast(cat.GROUP_DDL)
    whole = groups.agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col("r_regionkey").alias("k"), group.alias("g")))), lambda x: x["g"]).alias("groups"))
    return whole.select(F.struct(F.lit("adblock").alias("format"), F.lit(86400).cast("long").alias("expires"), F.lit(True).alias("enabled")).alias("defaults"), "groups")


T_LIST = [x.split(":")[0].strip() for x in cat.LIST_DDL.removeprefix("struct<").split("covered_by")[0].replace("array<string>", "a").split(",") if ":" in x] + ["covered_by"]

_CATALOGUE = """r AS (SELECT n_regionkey * 100000 + row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS pos, n_nationkey AS k, r_name, CASE WHEN n_nationkey % 11 = 10 THEN 'n1' ELSE 'n' || n_nationkey END AS id,
 CASE WHEN n_nationkey % 7 = 6 THEN 'HTTPS://l.org/n2.txt/?v=1' WHEN n_nationkey % 2 = 0 THEN 'https://l.org/n' || n_nationkey || '.txt' ELSE 'https://base.org/f' || n_nationkey || '.txt' END AS url, n_name FROM nation JOIN region ON n_regionkey = r_regionkey),
e AS (SELECT *, rtrim(regexp_replace(split_part(lower(url), '?', 1), '^https?://', ''), '/') AS key FROM r WHERE k % 5 <> 4),
u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY pos) AS n FROM e) x WHERE n = 1),
v AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos) AS m FROM u) x WHERE m = 1)"""


@query(f"WITH {_CATALOGUE} SELECT CAST(pos AS BIGINT) AS pos, id, url, r_name AS \"group\", replace(lower(n_name), '_', '-') || '.txt' AS file, 86400 AS expires FROM v")
def src02_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.unfold(_catalogue(spark, sf_dir)).select("pos", "id", "url", "group", "file", F.col("expires").cast("int").alias("expires"))


@query(f"WITH {_CATALOGUE} SELECT id FROM v WHERE lower(r_name) IN ('asia', 'europe') AND contains(lower(id || ' ' || n_name), '1')")
def src04_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.select_lists(cat.unfold(_catalogue(spark, sf_dir)), ["ASIA", "europe"], ["1", "none"]).select("id")


_STATE = """s AS (SELECT c_custkey, c_custkey % 5 AS k, c_custkey % 3 AS a FROM customer),
t AS (SELECT c_custkey, CASE WHEN a = 0 THEN 'fresh' WHEN k = 0 THEN 'failed' WHEN k = 1 THEN 'unchanged' WHEN k = 2 THEN 'failed' WHEN k = 3 THEN 'updated' ELSE 'unchanged' END AS status FROM s)"""


def _refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = syn.sql(spark, sf_dir, "SELECT * FROM customer").select(F.col("c_custkey").cast("string").alias("id"), (F.col("c_custkey") % 5).alias("k"), (F.col("c_custkey") % 3).alias("a"))
    body = F.concat(F.lit("||a.com^ and more than thirty-two characters "), "id")
    state = rows.select("id", F.lit(None).cast("string").alias("etag"), F.lit(None).cast("string").alias("last_modified"), F.sha2(body.cast("binary"), 256).alias("sha256"), F.when(F.col("a") == 0, "2026-01-01T11:00:00Z").when(F.col("a") == 1, "2025-12-01T00:00:00Z").alias("fetched_at"))
    fetched = rows.filter("k <> 0").select("id", F.when(F.col("k") == 1, 304).otherwise(200).alias("code"), F.when(F.col("k") == 2, "short").when(F.col("k") == 3, F.concat(body, F.lit(" new"))).when(F.col("k") == 4, body).alias("content"))
    now = "2026-01-01T12:00:00Z"
    return cat.refresh_state(cat.refresh_plan(rows.select("id", F.lit(86400).alias("expires")), state, now), fetched, now)


@query(f"WITH {_STATE} SELECT CAST(c_custkey AS VARCHAR) AS id, status FROM t")
def src07_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir).select("id", "status")


@query(f"WITH {_STATE} SELECT status, count(*) AS n FROM t GROUP BY status")
def ag12_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.status_summary(_refreshed(spark, sf_dir))


@query("SELECT 'f' || n_nationkey AS file FROM nation WHERE n_nationkey % 3 <> 0")
def jn10_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = syn.sql(spark, sf_dir, "SELECT * FROM nation").select("n_nationkey", F.concat(F.lit("f"), "n_nationkey").alias("file"))
    return output.stale(files.select("file"), files.filter("n_nationkey % 3 = 0").select("file"))


@query("SELECT 'k' || n_nationkey AS id, 'https://a.org/' || n_nationkey AS url, n_nationkey % 4 <> 1 AS on_ FROM nation WHERE n_nationkey % 5 <> 0")
def src15_from_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    asset = F.struct(F.when(k % 5 == 0, "internal").otherwise("filters").alias("content"), F.lit("g").alias("group"), F.when(k % 2 == 0, F.concat(F.lit('["assets/x","http://a.org/'), k, F.lit('"]'))).otherwise(F.concat(F.lit("https://a.org/"), k)).alias("contentURL"), F.col("n_name").alias("title"), (k % 4 == 1).alias("off"))
    row = syn.sql(spark, sf_dir, "SELECT * FROM nation").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("k"), k), asset)))).alias("json"))
    ids = spark.createDataFrame([], "key string, id string")
    made = cat.from_assets(row, ids, spark.createDataFrame([("g", 1)], "`group` string, pos int"))
    return made.select("id", "url", (F.size("tags") > 0).alias("on_"))
