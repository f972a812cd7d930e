"""Scalar functions, Column -> Column. Null in, null out, unless a function says otherwise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as C


def hex_to_rgb(text: Column, hash_required: bool = False) -> Column:
    """struct<r, g, b> of "#RRGGBB" ("#" optional unless required); null if it isn't one."""
    clean = F.regexp_extract(F.trim(text), r"^#([0-9A-Fa-f]{6})$" if hash_required else r"^#?([0-9A-Fa-f]{6})$", 1)
    channel = lambda k: F.conv(F.substring(clean, 2 * k + 1, 2), 16, 10).cast("int")
    return F.when(clean != "", F.struct(channel(0).alias("r"), channel(1).alias("g"), channel(2).alias("b")))


def rgb_to_hex(r: Column, g: Column, b: Column) -> Column:
    return F.format_string("#%02X%02X%02X", r.cast("int"), g.cast("int"), b.cast("int"))


def slugify(text: Column, fallback: str | None = C.SLUG_FALLBACK) -> Column:
    """Lower-case slug of [a-z0-9_-]; an empty one is the fallback (null: an error for the caller)."""
    slug = F.lower(F.regexp_replace(F.regexp_replace(F.trim(text), r"[^A-Za-z0-9_-]+", "-"), r"^[-_]+|[-_]+$", ""))
    return F.coalesce(F.nullif(slug, F.lit("")), F.lit(fallback))


def pascal_case(text: Column, fallback: str = "Asset") -> Column:
    """ASCII alphanumeric words with their first letter upper, the rest as it is."""
    words = F.regexp_extract_all(text, F.lit(r"([A-Za-z0-9]+)"), F.lit(1))
    joined = F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, F.lit(2), F.length(w)))), "")
    return F.coalesce(F.nullif(joined, F.lit("")), F.lit(fallback))


def parse_pair(text: Column) -> Column:
    """struct<w, h> of "WxH" (x, X or ×), both positive; else null."""
    part = lambda k: F.regexp_extract(F.trim(text), r"^(\d{1,9})\s*[xX×]\s*(\d{1,9})$", k).try_cast("int")
    return F.when((part(1) > 0) & (part(2) > 0), F.struct(part(1).alias("w"), part(2).alias("h")))


def parse_asset(text: Column, state: str = "Default") -> Column:
    """struct<name, state, description> of "name|state|description", two splits at most; null without a name."""
    parts = F.transform(F.split(text, r"\|", 3), lambda x: F.trim(x))
    at = lambda k, other: F.coalesce(F.nullif(F.get(parts, F.lit(k)), F.lit("")), F.lit(other))
    return F.when(parts[0] != "", F.struct(parts[0].alias("name"), at(1, state).alias("state"), at(2, "").alias("description")))


def asset_key(category: Column, name: Column, state: Column) -> Column:
    """Key of an asset: the category is trimmed, name and state are trimmed and folded to lower case."""
    return F.concat_ws("|", F.trim(category), F.lower(F.trim(name)), F.lower(F.trim(state)))


def panel_frame_key(style: Column) -> Column:
    return F.coalesce(F.nullif(F.lower(F.trim(style)), F.lit("")), F.lit("default"))


def file_name(prefix: Column, category: Column, name: Column, state: Column, index: Column) -> Column:
    """NN_Category_Name_State_III.png."""
    return F.format_string("%s_%s_%s_%s_%03d.png", prefix, category, pascal_case(name), pascal_case(state, "Default"), index.cast("int"))


def job_id(category: Column, sheet: Column) -> Column:
    return F.format_string("%s-sheet-%02d", F.lower(F.replace(category, F.lit("_"), F.lit("-"))), sheet.cast("int"))


def path_is_safe(path: Column, prefix: str = "") -> Column:
    """Relative, without "..", and under the prefix."""
    clean = F.replace(path, F.lit("\\"), F.lit("/"))
    rooted = clean.startswith("/") | clean.rlike("^[A-Za-z]:")
    return (clean != "") & ~rooted & ~F.array_contains(F.split(clean, "/"), "..") & (clean.startswith(prefix) if prefix else F.lit(True))


def safe_file_name(name: Column) -> Column:
    return F.regexp_replace(name, r'[<>:"/\\|?*\x00-\x1f]', "_")


def relative_path(path: Column, root: Column) -> Column:
    """path below root with "/" between its parts; null if it isn't below."""
    clean = F.replace(path, F.lit("\\"), F.lit("/"))
    base = F.concat(F.regexp_replace(F.replace(root, F.lit("\\"), F.lit("/")), "/+$", ""), F.lit("/"))
    return F.when(F.startswith(clean, base), F.substring(clean, F.length(base) + 1, F.length(clean)))


def rule_of(code: Column, severity: Column) -> Column:
    """struct<dimension, penalty>: the code's own rule, else by what it contains; only the latter scale by severity."""
    own = reduce(lambda out, r: out.when(code == r[0], F.struct(F.lit(r[1][0]).alias("dimension"), F.lit(r[1][1]).alias("penalty"))), list(C.ISSUE_RULES.items())[1:], F.when(code == next(iter(C.ISSUE_RULES)), F.struct(F.lit(next(iter(C.ISSUE_RULES.values()))[0]).alias("dimension"), F.lit(next(iter(C.ISSUE_RULES.values()))[1]).alias("penalty"))))
    for part, dimension, fail, other in C.FALLBACK_RULES:
        own = own.when(code.contains(part) if part else F.lit(True), F.struct(F.lit(dimension).alias("dimension"), F.when(severity == "fail", fail).otherwise(other).alias("penalty")))
    return own


def correction_of(code: Column) -> Column:
    """struct<instruction, target> of an issue: what its correction asks for, and what the retry replaces."""
    own = lambda table: F.element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), code)
    instruction, target = F.lit(None).cast("string"), F.lit(None).cast("string")
    for part, text, where in reversed(C.FALLBACK_CORRECTIONS):
        fits = code.contains(part) if part else F.lit(True)
        instruction, target = F.when(fits, text).otherwise(instruction), F.when(fits, where).otherwise(target)
    known = code.isin(*C.ISSUE_INSTRUCTIONS)
    return F.when(code.isNotNull(), F.struct(F.when(known, own(C.ISSUE_INSTRUCTIONS)).otherwise(instruction).alias("instruction"), F.when(known, F.coalesce(own(C.RETRY_TARGETS), F.lit(C.SHEET))).otherwise(target).alias("target")))


def retry_paths(code: Column, target: Column, mode: Column, sheet: Column, matte: Column, provenance: Column) -> Column:
    """Paths that a retry replaces. Defects of the source itself replace the sheet alone, whatever their target."""
    of_source = code.startswith("source-") | (code == "status-green-reflection")
    alone = F.when((target == C.MATTE) & matte.isNotNull(), F.array(matte)).when((target == C.PROVENANCE) & provenance.isNotNull(), F.array(provenance))
    return F.when(of_source, F.array(sheet)).otherwise(F.coalesce(alone, F.when(mode == "model-matte-derived", F.array(sheet, matte)).otherwise(F.array(sheet))))


def quality_status(score: Column, blockers: Column) -> Column:
    out = F.when(blockers > 0, "blocked")
    for least, name in C.QUALITY_BANDS:
        out = out.when(score >= least, name)
    return out.otherwise("poor")


def severity_rank(severity: Column) -> Column:
    """0 info, 1 warning, 2 fail; others rank as warnings."""
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, C.SEVERITIES)), severity), F.lit(0)) - 1, F.lit(1)).cast("int")


def severity_name(rank: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, C.SEVERITIES)), rank.cast("int") + 1)


def clip(x: Column, low, high) -> Column:
    return F.greatest(F.least(x, F.lit(high)), F.lit(low))


def is_close(a: Column, b: Column, relative: float = 0.01, absolute: float = 0.01) -> Column:
    return F.abs(a - b) <= F.greatest(F.greatest(F.abs(a), F.abs(b)) * relative, F.lit(absolute))


def subject_colours(text: Column) -> Column:
    """Sorted colours that a description declares (substring of its lower case)."""
    low = F.lower(text)
    found = [F.when(reduce(lambda a, b: a | b, (low.contains(t) for t in terms)), F.lit(colour)) for colour, terms in C.COLOUR_TERMS.items()]
    return F.array_sort(F.array_compact(F.array(*found)))


def choose_chroma_key(conflicts: Column) -> Column:
    """First candidate whose colour isn't among the conflicts; null if all are."""
    out = F.lit(None).cast("string")
    for key, colour in reversed(C.CHROMA_KEYS):
        out = F.when(~F.array_contains(conflicts, colour), F.lit(key)).otherwise(out)
    return out


def chroma_key_choice(requested: Column, conflicts: Column) -> Column:
    """struct<key, mode, issue>: the requested key, or the first without a conflict where it is auto or absent.

    A requested key whose colour the subject has, and subjects that have the colours of all keys, are issues.
    """
    wanted = F.upper(F.coalesce(requested, F.lit("auto")))
    names = F.create_map(*(F.lit(x) for pair in C.CHROMA_KEYS for x in pair))
    explicit = wanted != "AUTO"
    clash = F.coalesce(F.array_contains(conflicts, F.element_at(names, wanted)), F.lit(False))
    free = choose_chroma_key(conflicts)
    issue = F.when(explicit & clash, "chroma-key-conflicts-with-subject").when(~explicit & free.isNull(), "no-chroma-key-without-conflict")
    return F.struct(F.when(explicit, F.when(~clash, wanted)).otherwise(free).alias("key"), F.when(explicit, "explicit").otherwise("auto-declared-palette").alias("mode"), issue.alias("issue"))


def generation_policy(mode: Column, most: Column, high_risk: Column) -> Column:
    """struct<mode, most, high_risk>: limits of concurrent calls within their bounds, with their defaults."""
    kind = F.coalesce(mode, F.lit("adaptive-parallel"))
    asked = F.coalesce(most, F.when(kind == "adaptive-parallel", C.CONCURRENCY_MOST).otherwise(C.CONCURRENCY_LEAST))
    limit = F.when(kind == "sequential-inputs", 1).otherwise(clip(asked, C.CONCURRENCY_LEAST, C.CONCURRENCY_MOST))
    return F.struct(kind.alias("mode"), limit.alias("most"), F.least(F.coalesce(high_risk, F.lit(C.HIGH_RISK_MOST)), limit).alias("high_risk"))


def generation_budget(categories: Column) -> Column:
    """Extra calls kept in reserve: one, one for each reserved category, one for chroma-risk icons of any kind; five at most."""
    own = sum(F.array_contains(categories, c).cast("int") for c in C.RESERVED_CATEGORIES)
    icons = F.arrays_overlap(categories, F.array(*map(F.lit, C.CHROMA_RISK_ICONS))).cast("int")
    return F.least(F.lit(C.RESERVE_MOST), own + icons + 1)


def risk_priority(category: Column) -> Column:
    out = F.lit(C.RISK_OTHER)
    for name, rank in C.RISK_PRIORITY.items():
        out = F.when(category == name, rank).otherwise(out)
    return out


# ---------------------------------------------------------------- boxes: structs of l, t, r, b, with r and b exclusive


def box(l: Column, t: Column, r: Column, b: Column) -> Column:  # noqa: E741
    return F.struct(l.alias("l"), t.alias("t"), r.alias("r"), b.alias("b"))


def padded(x: Column, padding: int, width: Column, height: Column) -> Column:
    return box(F.greatest(x["l"] - padding, F.lit(0)), F.greatest(x["t"] - padding, F.lit(0)), F.least(x["r"] + padding, width), F.least(x["b"] + padding, height))


def area(x: Column) -> Column:
    return F.greatest(x["r"] - x["l"], F.lit(0)) * F.greatest(x["b"] - x["t"], F.lit(0))


def overlap_area(a: Column, b: Column) -> Column:
    return F.greatest(F.least(a["r"], b["r"]) - F.greatest(a["l"], b["l"]), F.lit(0)) * F.greatest(F.least(a["b"], b["b"]) - F.greatest(a["t"], b["t"]), F.lit(0))


def iou(a: Column, b: Column) -> Column:
    both = overlap_area(a, b)
    return F.coalesce(F.try_divide(both.cast("double"), (area(a) + area(b) - both).cast("double")), F.lit(0.0))


def gap(a: Column, b: Column) -> Column:
    """Distance between two boxes, 0 where they meet."""
    return F.hypot(F.greatest(F.greatest(a["l"], b["l"]) - F.least(a["r"], b["r"]), F.lit(0)).cast("double"), F.greatest(F.greatest(a["t"], b["t"]) - F.least(a["b"], b["b"]), F.lit(0)).cast("double"))


def touches_boundary(x: Column, width: Column, height: Column, tolerance: int = 1) -> Column:
    return (x["l"] <= tolerance) | (x["t"] <= tolerance) | (x["r"] >= width - tolerance) | (x["b"] >= height - tolerance)


def pixels_per_unit(smallest_scale: Column, default: float = 100.0) -> Column:
    """max(default, 100 / the smallest of the scales), to four places, half to even."""
    return F.bround(F.greatest(F.lit(default), F.coalesce(F.try_divide(F.lit(100.0), smallest_scale), F.lit(default))), 4)


# ---------------------------------------------------------------- pixels


def colour_distance(a: tuple[Column, ...], b: tuple) -> Column:
    return F.sqrt(sum(F.pow(x.cast("double") - (y if isinstance(y, Column) else F.lit(float(y))), F.lit(2.0)) for x, y in zip(a, b, strict=True)))


def spill_score(rgb: tuple[Column, Column, Column], key: tuple[int, int, int]) -> Column:
    """How far the key's high channels stand above its low ones; 0 for keys without both."""
    high, low = [c for c, k in zip(rgb, key, strict=True) if k >= 240], [c for c, k in zip(rgb, key, strict=True) if k <= 15]
    if not high or not low:
        return F.lit(0.0)
    least = high[0] if len(high) == 1 else F.least(*high)
    return (least - (low[0] if len(low) == 1 else F.greatest(*low))).cast("double")


def luma(r: Column, g: Column, b: Column) -> Column:
    return C.LUMA[0] * r + C.LUMA[1] * g + C.LUMA[2] * b


# ---------------------------------------------------------------- digests


def composed_fingerprint(parts: Column) -> Column:
    """SHA-256 of array<struct<ord, path, digest>> joined in order of ord; null if any digest is."""
    ordered = F.array_sort(parts)
    text = F.array_join(F.transform(ordered, lambda p: F.concat(p["path"], p["digest"])), "")
    return F.when(~F.exists(ordered, lambda p: p["digest"].isNull()), F.sha2(text, 256))


def is_sha256(text: Column) -> Column:
    return text.rlike("^[0-9a-f]{64}$")


def managed_block(existing: Column, generated: Column, begin: str, end: str) -> Column:
    """existing with its first begin...end block replaced by the generated one, or that appended."""
    block = F.concat(F.lit(f"{begin}\n"), F.rtrim(generated), F.lit(f"\n{end}\n"))
    found = existing.contains(begin) & existing.contains(end)
    pattern = f"(?s)^(.*?){begin}.*?{end}\\n?(.*)$"
    swapped = F.concat(F.regexp_extract(existing, pattern, 1), block, F.regexp_extract(existing, pattern, 2))
    return F.when(found, swapped).otherwise(F.concat(F.when(F.trim(existing) == "", "").otherwise(F.concat(F.rtrim(existing), F.lit("\n\n"))), block))
