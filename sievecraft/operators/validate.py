"""Structural checks of rule files: what the target would refuse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievecraft.functions import columns as c
from sievecraft.profile import TRIGGER_DDL, TRIGGER_KEYS, Profile

RULE_DDL = f"trigger {TRIGGER_DDL.replace('struct', 'struct', 1)}, action struct<type: string, selector: string>"


def parse_files(files: DataFrame) -> DataFrame:
    """(file, place, trigger, action, selector, keys) of the rules in ``files`` (file, content: a JSON array)."""
    raw = files.select("file", F.posexplode(F.from_json("content", "array<string>")).alias("place", "j"))
    keys = F.json_object_keys(F.get_json_object("j", "$.trigger"))
    rule = F.from_json("j", RULE_DDL)
    return raw.select("file", "place", keys.alias("keys"), rule.alias("r")).select("file", "place", "keys", "r.trigger", F.col("r.action.type").alias("action"), F.col("r.action.selector").alias("selector"))


def faults(rules: DataFrame, profile: Profile | None = None, max_rules: int | None = None) -> DataFrame:
    """(file, place, fault) of every rule that the target would refuse, and of files with too many rules or none."""
    profile = profile or Profile()
    unknown = F.size(F.array_except("keys", F.array(*map(F.lit, TRIGGER_KEYS)))) > 0
    action = F.coalesce("action", F.lit(""))
    css = (action == "css-display-none") & (F.coalesce("selector", F.lit("")) == "")
    fault = F.when(unknown, "val_key").otherwise(F.coalesce(c.trigger_fault(F.col("trigger"), action, profile), F.when(css, "val_selector")))
    out = rules.select("file", "place", fault.alias("fault")).filter("fault IS NOT NULL")
    many = rules.groupBy("file").agg(F.count("*").alias("n")).filter(F.col("n") > (max_rules or profile.max_rules))
    return out.unionByName(many.select("file", F.lit(-1).alias("place"), F.lit("file_size").alias("fault")))


def histogram(found: DataFrame, n: int = 20) -> DataFrame:
    return found.groupBy("fault").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "fault").limit(n)
