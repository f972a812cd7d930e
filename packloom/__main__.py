"""Command line: `python -m packloom plan | validate | diagnose | correct | catalog ...`; JSON on stdout, exit code 2 where the result isn't ok."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from packloom.functions import scalars as S
from packloom.operators import corrections, diagnosis, planning, tables, validation
from packloom.operators.lineage import cut
from packloom.sources import files

#: Fields of a manifest's assets that validation reads, beside the file's name.
ASSET = "id string, job_id string, category string, output string, width int, height int, category_index int, chroma_key string, transparency_mode string, alpha_origin string, source_sha256 string, alpha_provenance string, alpha_matte string, alpha_matte_sha256 string"
DOCUMENT = f"project_id string, expected_count int, chroma_key string, assets array<struct<{', '.join(x.replace(' ', ':') for x in ASSET.split(', ')).replace(', ', ',')}>>"


def plan(spark: SparkSession, requests: str, output: str, overwrite: bool) -> tuple[bool, dict]:
    """Jobs, assets, aliases, slots and issues of a folder of request documents, as JSON tables below output."""
    found = planning.batch_plan(files.requests(spark, requests))
    mode = "overwrite" if overwrite else "errorifexists"
    for name in ("jobs", "assets", "aliases", "slots", "issues"):
        getattr(found, name).write.mode(mode).json(f"{output}/{name}")
    planning.job_documents(found).write.mode(mode).json(f"{output}/requests")
    issues = found.issues.count()
    return issues == 0, {"jobs": found.jobs.count(), "assets": found.assets.count(), "issues": issues}


def _below(spark: SparkSession, root: str) -> tuple[str, str]:
    """root as a URI, and its path."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(root)
    uri = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hadoop).toUri()
    return uri.toString(), uri.getPath().rstrip("/")


def validate(spark: SparkSession, manifest: str, root: str, output: str, strict: bool, overwrite: bool) -> tuple[bool, dict]:
    """Issues and the report of one manifest over the images below root, as JSON tables below output.

    The manifest is a JSON document (project_id, expected_count, chroma_key, assets); its assets name files relative to root.
    """
    documents = spark.read.schema(DOCUMENT).option("multiLine", True).json(manifest)
    pack = F.coalesce("project_id", F.lit("game-ui")).alias("pack")
    packs = documents.select(pack, F.coalesce("expected_count", F.size("assets")).alias("expected"), "chroma_key")
    entries = documents.select(pack, F.posexplode("assets").alias("ord", "a")).select("pack", "ord", "a.*")
    name = packs.first().pack
    base = _below(spark, root)[1]
    below = F.substr(F.regexp_replace("path", "^[A-Za-z0-9]+:/+", "/"), F.lit(len(base) + 2)).alias("file")
    listed = files.listing(spark, root, "*").select(F.lit(name).alias("pack"), below)
    images = files.packed_images(files.images(spark, root, recursive=True)).where("rgba IS NOT NULL").select(F.lit(name).alias("pack"), below, "width", "height", "channels", "rgba")
    issues = cut(validation.pack_issues(packs, entries, images, listed, strict))
    reports = validation.pack_reports(packs, entries, issues)
    mode = "overwrite" if overwrite else "errorifexists"
    issues.write.mode(mode).json(f"{output}/issues")
    reports.write.mode(mode).json(f"{output}/reports")
    report = reports.first().asDict()
    return report.pop("ok"), report


def correct(spark: SparkSession, image: str, document: str, project: str, output: str, overwrite: bool) -> tuple[bool, dict]:
    """One sheet's approved corrections: PNGs below output/final and output/qa, JSON tables of entries, issues and the report."""
    documents = spark.read.schema(corrections.DOCUMENT).option("multiLine", True).json(document).withColumn("project", F.lit(project))
    settings, candidates = corrections.split(documents)
    sheets = cut(files.packed_images(files.images(spark, image)).select(F.lit(project).alias("project"), "width", "height", "rgba"))
    done = corrections.applied(settings, candidates, sheets)
    issues, mode = cut(done.issues), "overwrite" if overwrite else "errorifexists"
    done.entries.write.mode(mode).json(f"{output}/entries")
    issues.write.mode(mode).json(f"{output}/issues")
    done.reports.write.mode(mode).json(f"{output}/reports")
    root = _below(spark, output)[0]
    files.write_pngs(done.images, root)
    files.write_pngs(corrections.review_images(candidates, sheets, issues).withColumn("file", F.lit("qa/bbox-review.png")), root)
    report = done.reports.first().asDict()
    return report["status"] == "complete", report


def diagnose(spark: SparkSession, image: str, category: str, project: str, output: str, least: int, room: int, near: float, overwrite: bool) -> tuple[bool, dict]:
    """One unknown sheet: JSON tables of its report, issues and document to correct, and a PNG of its candidates below output/qa.

    Once somebody has set `approved` in the document, `correct` applies it.
    """
    sheets = cut(files.packed_images(files.images(spark, image)).select(F.lit(project).alias("project"), F.lit(category).alias("category"), "width", "height", "rgba"))
    found, mode = diagnosis.diagnosed(sheets, least, room, near), "overwrite" if overwrite else "errorifexists"
    reports = cut(found.reports)
    reports.write.mode(mode).json(f"{output}/reports")
    found.issues.orderBy("ord").coalesce(1).write.mode(mode).json(f"{output}/issues")
    diagnosis.documents(found, least, room, near).coalesce(1).write.mode(mode).json(f"{output}/corrections")
    files.write_pngs(diagnosis.overlays(found.candidates, sheets).withColumn("file", F.lit("qa/candidates.png")), _below(spark, output)[0])
    report = reports.drop("background").first().asDict()
    return report["status"] == "ready-for-review", report


def catalog(spark: SparkSession, manifest: str, earlier: str | None, run: str, output: str, overwrite: bool) -> tuple[bool, dict]:
    """The catalog in the table of an earlier one (none: empty) merged with a manifest's assets that didn't fail, as a table sorted by key.

    The output is another folder than the earlier catalog. Of a manifest's assets of one key the last stands.
    """
    own = "id string, category string, semantic_name string, state string, output string, width int, height int, qa string"
    listed = spark.read.schema(f"assets array<struct<{own}>>").option("multiLine", True).json(manifest).select(F.posexplode("assets").alias("ord", "a")).select("ord", "a.*")
    listed = listed.withColumns({"qa": F.coalesce("qa", F.lit("pass")), "state": F.coalesce("state", F.lit("Default")), "width": F.coalesce("width", F.lit(0)), "height": F.coalesce("height", F.lit(0)), "source_run": F.lit(run)}).where("qa <> 'fail'")
    new = listed.withColumn("asset_key", S.asset_key(F.col("category"), F.col("semantic_name"), F.col("state")))
    old = spark.read.schema(f"asset_key string, ord int, {own}, source_run string").json(earlier) if earlier else spark.createDataFrame([], new.schema)
    merged = cut(tables.upsert(old, new.select(*old.columns), "asset_key", ["ord"]))
    merged.drop("action").orderBy("asset_key").write.mode("overwrite" if overwrite else "errorifexists").json(output)
    counts = merged.agg(F.count_if(F.col("action") == "added").alias("added"), F.count("*").alias("total")).first()
    return True, {"added": counts.added, "updated": new.count() - counts.added, "total": counts.total}


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="packloom", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    one = commands.add_parser("plan", help="plan request documents")
    one.add_argument("--requests", required=True)
    two = commands.add_parser("validate", help="validate packs")
    two.add_argument("--manifest", required=True)
    two.add_argument("--asset-root", required=True)
    two.add_argument("--strict-files", action="store_true")
    three = commands.add_parser("correct", help="apply approved boxes to a sheet")
    three.add_argument("--input", required=True)
    three.add_argument("--corrections", required=True)
    three.add_argument("--project-id", required=True)
    four = commands.add_parser("catalog", help="merge a manifest into a catalog")
    four.add_argument("--manifest", required=True)
    four.add_argument("--catalog", help="folder of an earlier catalog")
    four.add_argument("--source-run", required=True)
    five = commands.add_parser("diagnose", help="find the candidates of an unknown sheet")
    five.add_argument("--input", required=True)
    five.add_argument("--category", required=True)
    five.add_argument("--project-id", required=True)
    five.add_argument("--min-component-pixels", type=int, default=diagnosis.LEAST)
    five.add_argument("--bbox-padding", type=int, default=diagnosis.ROOM)
    five.add_argument("--background-threshold", type=float, default=diagnosis.NEAR)
    for command in (one, two, three, four, five):
        command.add_argument("--output", required=True)
        command.add_argument("--force", action="store_true", help="overwrite earlier results")
    a = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("packloom").getOrCreate()
    run = {
        "plan": lambda: plan(spark, a.requests, a.output, a.force),
        "validate": lambda: validate(spark, a.manifest, a.asset_root, a.output, a.strict_files, a.force),
        "correct": lambda: correct(spark, a.input, a.corrections, a.project_id, a.output, a.force),
        "diagnose": lambda: diagnose(spark, a.input, a.category, a.project_id, a.output, a.min_component_pixels, a.bbox_padding, a.background_threshold, a.force),
        "catalog": lambda: catalog(spark, a.manifest, a.catalog, a.source_run, a.output, a.force),
    }
    ok, result = run[a.command]()
    print(json.dumps({"ok": ok, **result}))
    return 0 if ok else 2


if __name__ == "__main__":
    sys.exit(main())
