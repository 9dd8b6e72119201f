"""The jobs as queries over the driver's tables: each runs its function twice into one new folder and returns what is there then."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import cohort_scores, text_catalogue
from skein.functions import domains, rules
from skein.session import shared_dir


def _twice(spark: SparkSession, name: str, run) -> DataFrame:
    out = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    run(out)
    return run(out)


def job1_cohort_scores(spark: SparkSession, d: str) -> DataFrame:
    out = _twice(spark, "job1", lambda out: cohort_scores.run(spark, d, out))
    return out.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in ("z", "percentile")})


def job2_text_catalogue(spark: SparkSession, d: str) -> DataFrame:
    return _twice(spark, "job2", lambda out: text_catalogue.run(spark, d, out)).drop("batch")


def queries() -> dict:
    return {"job1_cohort_scores": job1_cohort_scores, "job2_text_catalogue": job2_text_catalogue}


_COHORT_SQL = """WITH s AS (SELECT c_custkey AS sample_id, r_name AS population FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey),
c AS (SELECT * FROM (SELECT sample_id, population, l_partkey AS variant, CAST(floor(l_quantity) AS INT) % 3 AS dosage, l_linenumber % 2 AS flip, row_number() OVER (PARTITION BY sample_id, l_partkey ORDER BY l_orderkey, l_linenumber, CAST(floor(l_quantity) AS INT) % 3) AS k
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN s ON o_custkey = sample_id) WHERE k = 1),
w AS (SELECT p_brand AS pgs_id, p_partkey AS variant, CAST(p_retailprice AS DOUBLE) / 1000 - 1 AS weight, p_size % 3 AS model FROM part),
j AS (SELECT sample_id, population, pgs_id, weight, model, CASE WHEN flip = 1 THEN 2.0 - dosage ELSE CAST(dosage AS DOUBLE) END AS d FROM c JOIN w USING (variant)),
m AS (SELECT sample_id, pgs_id, sum(weight * CAST(CASE model WHEN 1 THEN least(d, 1.0) WHEN 2 THEN CASE WHEN d >= 2 THEN 1.0 ELSE 0.0 END ELSE d END AS DOUBLE)) AS x, count(*) AS n FROM j GROUP BY ALL),
r AS (SELECT u.sample_id, u.population, t.pgs_id, round(coalesce(x, 0), 6) + 0.0 AS raw_score, coalesce(n, 0) AS variants_matched, round(coalesce(n, 0) / CAST(total AS DOUBLE), 6) AS match_rate
  FROM (SELECT DISTINCT sample_id, population FROM j) u CROSS JOIN (SELECT pgs_id, count(*) AS total FROM w GROUP BY 1) t LEFT JOIN m ON m.sample_id = u.sample_id AND m.pgs_id = t.pgs_id),
g AS (SELECT *, avg(raw_score) OVER p AS mean, stddev_pop(raw_score) OVER p AS std, count(*) OVER p AS total, count(*) OVER (PARTITION BY population, pgs_id ORDER BY raw_score) AS upto, count(*) OVER (PARTITION BY population, pgs_id, raw_score) AS same
  FROM r WINDOW p AS (PARTITION BY population, pgs_id))
SELECT sample_id, pgs_id, raw_score, variants_matched, match_rate, round(CASE WHEN std > 0 THEN (raw_score - mean) / std ELSE 0 END, 6) + 0.0 AS z, round(50.0 * (upto - same + upto + 1) / total, 6) + 0.0 AS percentile, population FROM g"""

_TIER = "greatest(4, " + ", ".join("CASE WHEN regexp_matches(text, '" + "|".join(f"(?:{p})" for p in ps).replace("'", "''") + f"', 'i') THEN {s} ELSE 0 END" for s, ps in rules.METHOD_TIERS) + ")"
_CASE = lambda words, other: "CASE " + " ".join(f"WHEN contains(low, '{k}') THEN '{v}'" for k, v in words) + f" ELSE '{other}' END"
_CATALOGUE_SQL = f"""SELECT doc_id, source, length(text) AS n_chars, CAST({_TIER} AS INT) AS method_tier, {_CASE(domains.BEHAVIOR_KEYWORDS, 'Other_Behavioral')} AS behaviour, {_CASE(domains.BODY_KEYWORDS, 'Other_Body')} AS body, lang
FROM (SELECT doc_id, source, lang, coalesce(text, '') AS text, lower(coalesce(text, '')) AS low FROM documents)"""


def oracle_sql() -> dict[str, str]:
    return {"job1_cohort_scores": _COHORT_SQL, "job2_text_catalogue": _CATALOGUE_SQL}
