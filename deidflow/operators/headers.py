"""Headers in long form: one row per element, with the path of the sequence items that enclose it.

Columns: uri, path (tag and item of each enclosing sequence, joined by /), tag, keyword, vr, value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deidflow import rules
from deidflow.functions.identity import apply_action, is_preserved_uid, remap_uid

#: Action tables above this size would not be rules; below, they are broadcast.
MAX_RULES = 10_000
METHOD = "deidflow: text redaction, header scrub, UID remap"
CODES = ("113100",)
PIXEL_CODE = "113101"


def action_table(spark: SparkSession, mapping: dict[str, str]) -> DataFrame:
    checked = rules.actions(mapping)
    if len(checked) > MAX_RULES:
        raise rules.RuleError("an action table of this size is not a rule list")
    return spark.createDataFrame(sorted(checked.items()), "tag string, action string")


def is_private(tag) -> F.Column:
    """Odd group numbers."""
    return F.conv(F.substring(tag, 2, 4), 16, 10).cast("int") % 2 == 1


def scrub(elements: DataFrame, mapping: dict[str, str], salt: str, keep_geometry: bool = False, drop_private: bool = True) -> DataFrame:
    """``elements`` with action and value_out; the order is actions, private drop, UID remap.

    A removed sequence takes everything below it along. action is null where nothing applies, REMAP for changed UIDs.
    """
    spark = elements.sparkSession
    joined = elements.join(F.broadcast(action_table(spark, mapping)), "tag", "left")
    if keep_geometry:
        joined = joined.withColumn("action", F.when(~F.coalesce(F.col("keyword"), F.lit("")).isin(*rules.GEOMETRY_KEYWORDS), F.col("action")))
    removed = [t for t, a in rules.actions(mapping).items() if a == "REMOVE"]
    steps = F.transform(F.split("path", "/"), lambda s: F.substring(s, 1, 11))
    below = F.arrays_overlap(steps, F.array(*(F.lit(t) for t in removed))) if removed else F.lit(False)
    gone = below | ((is_private(F.col("tag")) | F.exists(steps, lambda s: F.coalesce(F.try_to_number(F.conv(F.substring(s, 2, 4), 16, 10), F.lit("999999")).cast("int"), F.lit(0)) % 2 == 1)) if drop_private else F.lit(False))
    kept = joined.where(~gone)
    value = F.when(F.col("action").isNull(), F.col("value")).otherwise(apply_action(F.col("action"), F.col("value"), F.col("vr"), salt))
    acted = kept.withColumn("value_out", value)
    uid = (F.col("vr") == "UI") & F.col("value_out").isNotNull() & ~is_preserved_uid(F.col("keyword"), F.col("value_out"))
    return acted.withColumn("value_out", F.when(uid, remap_uid(F.col("value_out"), salt)).otherwise(F.col("value_out"))).withColumn("action", F.when(uid, "REMAP").otherwise(F.col("action")))


def audit(scrubbed: DataFrame) -> DataFrame:
    """The rows where an action was applied, with redacted (false for KEEP)."""
    return scrubbed.where("action IS NOT NULL").select("uri", "tag", "keyword", "action", (F.col("action") != "KEEP").alias("redacted"))


def output(scrubbed: DataFrame) -> DataFrame:
    """The elements that remain, with their new values."""
    return scrubbed.where("action IS NULL OR action <> 'REMOVE'").select("uri", "path", "tag", "keyword", "vr", F.col("value_out").alias("value"))


def attest(elements: DataFrame, injected: DataFrame | None = None) -> DataFrame:
    """``elements`` with the attestation stamps of every file; ``injected`` (uri) are files whose pixels were written back."""
    files = elements.select("uri").distinct()
    files = files.withColumn("pixels", F.lit(False)) if injected is None else files.join(injected.select("uri").distinct().withColumn("pixels", F.lit(True)), "uri", "left").withColumn("pixels", F.coalesce("pixels", F.lit(False)))
    codes = F.concat(F.array(*(F.lit(c) for c in CODES)), F.when(F.col("pixels"), F.array(F.lit(PIXEL_CODE))).otherwise(F.array().cast("array<string>")))
    stamp = lambda t, k, vr, v: F.struct(F.lit("").alias("path"), F.lit(t).alias("tag"), F.lit(k).alias("keyword"), F.lit(vr).alias("vr"), v.alias("value"))
    burned = stamp("(0028,0301)", "BurnedInAnnotation", "CS", F.lit("NO"))
    stamps = F.concat(
        F.array(
            stamp("(0012,0062)", "PatientIdentityRemoved", "CS", F.lit("YES")), stamp("(0012,0063)", "DeidentificationMethod", "LO", F.lit(METHOD)),
            stamp("(0012,0064)", "DeidentificationMethodCodeSequence", "SQ", F.array_join(codes, "\\")),
        ),
        F.when(F.col("pixels"), F.array(burned)).otherwise(F.slice(F.array(burned), F.lit(1), F.lit(0))),
    )
    rows = files.select("uri", F.explode(stamps).alias("s")).select("uri", "s.*")
    tags = rows.select("uri", "tag", "path")
    return elements.join(tags, ["uri", "tag", "path"], "left_anti").unionByName(rows.select(*elements.columns))


def diff(before: DataFrame, after: DataFrame, key: str = "uri") -> DataFrame:
    """Counts by file: removed, private removed, dummied and zeroed elements, by a full outer join on the tag."""
    b = before.select(key, "tag", F.col("value").alias("old"), F.lit(True).alias("_b"))
    a = after.select(key, "tag", F.col("value").alias("new"), F.lit(True).alias("_a"))
    both = b.join(a, [key, "tag"], "full_outer")
    gone, changed = F.col("_a").isNull(), F.col("_a").isNotNull() & F.col("_b").isNotNull() & ~F.col("old").eqNullSafe(F.col("new"))
    return both.groupBy(key).agg(
        F.count_if(gone & ~is_private(F.col("tag"))).alias("removed"), F.count_if(gone & is_private(F.col("tag"))).alias("private_removed"),
        F.count_if(changed & F.col("new").startswith("TOKEN_")).alias("dummied"), F.count_if(changed & F.col("new").isin("", "0", "00000000")).alias("zeroed"),
    )
