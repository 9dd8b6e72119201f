"""Command line: score, quality, cohort, analyze.

    python -m skein score --vcf CALLS --scores FOLDER --ids PGS1,PGS2 --out FOLDER
    python -m skein quality --catalog FILE [--performance FILE] [--match-rates TSV] [--population EUR] --out FOLDER
    python -m skein cohort --root FOLDER --manifest CSV --matrix FOLDER --pcs TSV --quality TSV --metadata PARQUET --families DISEASE=FAMILY,... --out FOLDER
    python -m skein analyze --model FOLDER --job FOLDER --sex M --age 50 --out FOLDER
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from skein.plans import bundle, report, scoring
from skein.plans import cohort as plans
from skein.session import build_session
from skein.sources import sinks, text


def score(spark: SparkSession, a: argparse.Namespace) -> None:
    scoring.run(spark, a.vcf, a.scores, a.ids.split(","), a.out, a.missing).orderBy("pgs_id").show(20, False)


def quality(spark: SparkSession, a: argparse.Namespace) -> None:
    rates = text.read_tsv(spark, a.match_rates).selectExpr("pgs_id", "try_cast(match_rate as double) as match_rate") if a.match_rates else None
    found = report.score_quality(text.read_catalog(spark, a.catalog), text.read_performance(spark, a.performance) if a.performance else None, rates, population=a.population)
    sinks.write_tsv(sinks.quality_table(found), f"{a.out}/quality")
    report.quality_summary(found).show()


def cohort(spark: SparkSession, a: argparse.Namespace) -> None:
    """The reference's score vectors are .npy files under --matrix, in the order of the rows of --pcs (sample_id, pc1, ...)."""
    pcs = text.read_tsv(spark, a.pcs)
    pcs = pcs.select("sample_id", *(F.col(c).cast("double") for c in pcs.columns if c != "sample_id"))
    placed = pcs.select("sample_id").rdd.zipWithIndex().map(lambda x: (x[0].sample_id, x[1])).toDF("sample_id string, place long")
    quality = text.read_tsv(spark, a.quality).selectExpr("pgs_id", "try_cast(total as double) as total")
    n_pcs = len(pcs.columns) - 1
    plans.run(spark, a.root, a.manifest, text.read_matrix(spark, a.matrix, placed), pcs, quality, text.read_metadata(spark, a.metadata), dict(x.split("=") for x in a.families.split(",")), a.out, n_pcs=n_pcs, **a.sizes)


def analyze(spark: SparkSession, a: argparse.Namespace) -> None:
    z, people = bundle.read_patient(spark, a.job, a.sex, a.age)
    bundle.patient_report(bundle.load(spark, a.model), z, people).select("report").write.mode("overwrite").text(f"{a.out}/report")


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="skein", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(required=True)
    for f, options in ((score, ("vcf", "scores", "ids", "out")), (quality, ("catalog", "out")), (cohort, ("root", "manifest", "matrix", "pcs", "quality", "metadata", "families", "out")), (analyze, ("model", "job", "sex", "age", "out"))):
        p = commands.add_parser(f.__name__)
        p.set_defaults(run=f)
        for o in options:
            p.add_argument(f"--{o}", required=True, type=float if o == "age" else str)
        if f is score:
            p.add_argument("--missing", choices=("zero", "null"), default="zero")
        if f is cohort:
            p.add_argument("--sizes", type=json.loads, default={}, help="parameters of the plan as JSON")
        if f is quality:
            p.add_argument("--performance")
            p.add_argument("--match-rates")
            p.add_argument("--population", default="EUR")
    found = parser.parse_args(arguments)
    found.run(SparkSession.getActiveSession() or build_session("skein"), found)


if __name__ == "__main__":
    main()
