"""Rule arrays: named predicates evaluated together, one issue for each that holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def broken(rules: dict[str, Column]) -> Column:
    """array<string> of the codes whose predicate holds, in order; a null predicate doesn't hold."""
    return F.array_compact(F.array(*(F.when(when, F.lit(code)) for code, when in rules.items())))


def first_broken(rules: dict[str, Column]) -> Column:
    """The first of them: what a validator that stops at once would report."""
    return F.get(broken(rules), F.lit(0))


def issues(rows: DataFrame, rules: dict[str, tuple[str, Column]], *keep: str) -> DataFrame:
    """One row for each broken rule, (severity, predicate) by code, with the columns to keep and its place."""
    found = F.array_compact(F.array(*(F.when(when, F.struct(F.lit(k).alias("ord"), F.lit(severity).alias("severity"), F.lit(code).alias("code"))) for k, (code, (severity, when)) in enumerate(rules.items()))))
    return rows.select(*keep, F.explode(found).alias("_issue")).select(*keep, "_issue.*")


#: Figures that an alpha matte must reach.
MATTE_LIMITS = {"border": 0.02, "gray": 4.0, "levels": 16, "partial": 64, "iou": 0.92, "coverage": 0.75, "support": 0.95}


def matte_rules(limits: dict | None = None) -> dict[str, tuple[str, Column]]:
    """Checks of a matte's statistics (columns gray_delta, border_alpha, flat_delta, zero, partial, levels, iou, coverage, support)."""
    m = MATTE_LIMITS | (limits or {})
    return {
        "matte-not-grayscale": ("fail", F.col("gray_delta") > m["gray"]),
        "matte-border-not-transparent": ("fail", F.col("border_alpha") > m["border"]),
        "matte-has-no-transparent-pixels": ("fail", F.col("zero") == 0),
        "insufficient-partial-alpha-pixels": ("fail", F.col("partial") < m["partial"]),
        "insufficient-alpha-levels": ("fail", F.col("levels") < m["levels"]),
        "source-matte-bbox-mismatch": ("fail", F.col("iou") < m["iou"]),
        "source-matte-pixel-mismatch": ("fail", (F.col("coverage") < m["coverage"]) | (F.col("support") < m["support"])),
    }


def provenance_rules() -> dict[str, tuple[str, Column]]:
    """Checks of a native-alpha provenance row."""
    return {
        "missing-native-alpha-provenance": ("fail", F.col("provenance_file").isNull()),
        "unsupported-native-alpha-provenance-schema": ("fail", F.coalesce("schema_version", F.lit(0)) != 1),
        "invalid-transparency-mode": ("fail", F.coalesce("transparency_mode", F.lit("")) != "native-alpha"),
        "unproven-native-alpha-origin": ("fail", F.coalesce("alpha_origin", F.lit("")) != "model-native"),
        "background-removal-not-native-alpha": ("fail", F.coalesce("background_removal", F.lit(False))),
        "provenance-source-path-mismatch": ("fail", ~F.col("declared_path").eqNullSafe(F.col("source_path"))),
        "provenance-source-hash-mismatch": ("fail", ~F.col("declared_sha256").eqNullSafe(F.col("source_sha256"))),
        "missing-generation-model": ("fail", F.coalesce(F.trim("model"), F.lit("")) == ""),
        "missing-generation-method": ("fail", F.coalesce(F.trim("method"), F.lit("")) == ""),
    }


def reference_role(name: Column) -> Column:
    """canonical, supporting or moodboard by the file name; null for other names."""
    return F.when(name.rlike(r"(?i)^canonical(?:[-_][a-z0-9_-]+)?\.(?:png|jpe?g|webp)$"), "canonical").when(name.rlike(r"(?i)^supporting[-_]\d{2}(?:[-_][a-z0-9_-]+)?\.(?:png|jpe?g|webp)$"), "supporting").when(name.rlike(r"(?i)^moodboard(?:[-_][a-z0-9_-]+)?\.(?:png|jpe?g|webp)$"), "moodboard")
