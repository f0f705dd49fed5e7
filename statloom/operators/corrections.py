"""A reviewed ledger of corrections: validated strictly, applied only where the source still says what was observed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCHEMA = "filename string, field string, observed string, corrected string, confidence string, evidence string, reviewedOn string"
TIERS = ("conclusive", "flagged")
#: Fields that a ledger may correct.
FIELDS = ("sectionNumber",)


def ledger_problems(ledger: DataFrame) -> DataFrame:
    """(filename, field, problem) of entries that break a rule; a sound ledger gives none."""
    rules = (
        (~F.col("confidence").isin(*TIERS) | F.col("confidence").isNull(), "confidence is conclusive or flagged"),
        ((F.col("confidence") == "conclusive") & F.col("corrected").isNull(), 'a conclusive entry needs "corrected"'),
        ((F.col("confidence") == "flagged") & F.col("corrected").isNotNull(), 'a flagged entry must not carry "corrected"'),
        (~F.col("field").isin(*FIELDS) | F.col("field").isNull(), "field is not correctable"),
        (F.coalesce(F.trim("evidence"), F.lit("")) == "", '"evidence" is required'),
        (F.count(F.lit(1)).over(Window.partitionBy("filename", "field")) > 1, "duplicate entry"),
    )
    found = ledger.select("filename", "field", F.array_compact(F.array(*(F.when(bad, F.lit(say)) for bad, say in rules))).alias("p"))
    return found.select("filename", "field", F.explode("p").alias("problem")).distinct()


def check_ledger(ledger: DataFrame) -> DataFrame:
    """The ledger, or an error with its first problems."""
    bad = ledger_problems(ledger).limit(5).collect()
    if bad:
        raise ValueError("; ".join(f"{r.filename} {r.field}: {r.problem}" for r in bad))
    return ledger


def apply_corrections(sections: DataFrame, ledger: DataFrame) -> DataFrame:
    """Sections with corrected numbers and recorded anomalies, and ``warning`` where an entry is stale.

    conclusive: the number changes, numberSource becomes "correction". flagged: only the anomaly is recorded. An entry whose
    observed value isn't the section's current one does nothing but warn. Sections without an entry stay as they are.
    """
    own = ledger.where("field = 'sectionNumber'").select("filename", *(F.col(c).alias(f"__{c}") for c in ("observed", "corrected", "confidence", "evidence")))
    s = sections.join(own, "filename", "left")
    fits = F.col("__observed").isNotNull() & F.col("sectionNumber").eqNullSafe(F.col("__observed"))
    change = fits & (F.col("__confidence") == "conclusive")
    note = F.struct(F.lit("sectionNumber").alias("field"), F.col("__observed").alias("observed"), F.when(change, F.col("__corrected")).alias("corrected"), F.col("__confidence").alias("confidence"), F.col("__evidence").alias("evidence"))
    new = {
        "sectionNumber": F.when(change, F.col("__corrected")).otherwise(F.col("sectionNumber")),
        "numberSource": F.when(change, F.lit("correction")).otherwise(F.col("numberSource")),
        "sourceAnomalies": F.when(fits, F.concat(F.coalesce("sourceAnomalies", F.array().cast(sections.schema["sourceAnomalies"].dataType)), F.array(note))).otherwise(F.col("sourceAnomalies")),
        "warning": F.when(F.col("__observed").isNotNull() & ~fits, F.concat(F.lit("not applied: observed "), F.col("__observed"), F.lit(", found "), F.coalesce("sectionNumber", F.lit("nothing")))),
    }
    return s.select(*(new[c].alias(c) if c in new else F.col(c) for c in sections.columns), new["warning"].alias("warning"))


def number_aliases(ledger: DataFrame) -> DataFrame:
    """(observed, corrected) of conclusive section numbers."""
    return ledger.where("field = 'sectionNumber' and confidence = 'conclusive'").select("observed", "corrected")


def merge_ledgers(*ledgers: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, ledgers)
