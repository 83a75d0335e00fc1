"""Joins.  A side is broadcast only after its size was looked at."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from jobmart.operators.layout import estimated_bytes
from jobmart.scratch import fresh_path, materialise
from jobmart.session import CBO_CONF

# Largest estimated size of a table that may be copied to every executor.  The estimate of a file
# scan is the size of the files; ten-fold compression would still be 200 MB in memory.
BROADCAST_LIMIT = 20 * 1024 * 1024


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast when the estimate is within ``limit``.

    Above it there is no hint: Spark shuffles both sides, and AQE splits skewed partitions or
    switches to a broadcast by the size it measures at run time.
    """
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def join_small(fact: DataFrame, dimension: DataFrame, on, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Inner join with a table that is expected, and checked, to be small."""
    return fact.join(broadcast_if_small(dimension, limit), on, "inner")


def join_large(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Inner sort-merge join of two large tables, asked for per join, not by a global setting."""
    return left.join(right.hint("merge"), on, "inner")


def join_three(
    jobs: DataFrame, company: DataFrame, role: DataFrame, on_company, on_role
) -> DataFrame:
    """(jobs ⨝ company) ⨝ role: the small dimension first, so less is shuffled for the second."""
    return join_small(jobs, company, on_company).join(role, on_role, "inner")


def collect_statistics(spark: SparkSession, *tables: str, columns: Sequence[str] = ()) -> None:
    """Table and column statistics of catalog tables, the input of cost-based reordering."""
    for table in tables:
        target = f"FOR COLUMNS {', '.join(columns)}" if columns else "FOR ALL COLUMNS"
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS {target}")


def enable_cost_based_join_order(spark: SparkSession) -> None:
    for key, value in CBO_CONF.items():
        spark.conf.set(key, value)


THREE_WAY_SQL = """
SELECT {columns}
FROM {fact} AS f
INNER JOIN {first} AS a ON f.{fact_first} = a.{first_key}
INNER JOIN {second} AS b ON {second_owner}.{owner_second} = b.{second_key}
"""


def three_way_sql(spark: SparkSession, **names: str) -> DataFrame:
    """Three-table inner join as SQL text over views or tables; the optimizer orders it."""
    return spark.sql(THREE_WAY_SQL.format(**names))


@contextmanager
def settings(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Session settings while the block runs; what was set before, or not set, is restored."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@contextmanager
def analysed_tables(spark: SparkSession, **tables: DataFrame) -> Iterator[dict[str, str]]:
    """Catalog tables with histograms of all columns, by the names given, while the block runs.

    The rows lie below the shared folder under names of their own; only the catalog entries are dropped.
    """
    names = {}
    try:
        for name, df in tables.items():
            path = fresh_path(spark, f"analysed-{name}")
            names[name] = f"jobmart_{name}_{path.rpartition('-')[2]}"
            df.write.option("path", path).saveAsTable(names[name])
        with settings(spark, {"spark.sql.statistics.histogram.enabled": "true"}):
            collect_statistics(spark, *names.values())
        yield names
    finally:
        for name in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def explode_skills(df: DataFrame, row_id: str, skills: str = "skills") -> DataFrame:
    """One row per (row, skill), each skill once per row."""
    return df.select(row_id, F.explode(F.array_distinct(skills)).alias("skill"))


def skill_supply_join(job_skills: DataFrame, resume_skills: DataFrame) -> DataFrame:
    """Every advertised skill with the number of résumés that offer it.

    The résumé side is counted per skill before the join, so a popular skill does not multiply
    adverts by résumés: the output has one row per (advert, skill).
    """
    supply = resume_skills.groupBy("skill").agg(F.count("*").alias("n_resumes"))
    return job_skills.join(supply, "skill", "inner")


def skill_overlap(job_skills: DataFrame, resume_skills: DataFrame) -> DataFrame:
    """Per skill: adverts, résumés, and the number of advert–résumé pairs that share it."""
    demand = job_skills.groupBy("skill").agg(F.count("*").alias("n_jobs"))
    supply = resume_skills.groupBy("skill").agg(F.count("*").alias("n_resumes"))
    pairs = F.col("n_jobs").cast("decimal(19,0)") * F.col("n_resumes").cast("decimal(19,0)")
    return demand.join(supply, "skill", "inner").withColumn("n_pairs", pairs)


def _band(size: Column) -> Column:
    """Size rounded down to four leading binary digits: close sizes share a band."""
    step = F.call_function("shiftleft", F.lit(1), F.greatest(F.length(F.bin(size)) - 4, F.lit(0)))
    return (size - size % step).cast("int")


HEAVY = 1024
#: Sets of fewer skills are joined on pairs of skills: about size² / 8 rows for a score of a half, where bands need 4 * size.
PAIRED_BELOW = 32
#: About so many rows of pairs are joined, and on disk, at a time.
PAIRS_AT_ONCE = 300_000_000
#: Skills of more sets are common.  In a large table the bound is higher, so that at most ``COMMON_SKILLS`` are broadcast.
COMMON_ABOVE = 256
COMMON_SKILLS = 1 << 18
#: For steps that end in a written table: their shuffle files are deleted then, not when the driver collects garbage.
STEP_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def _with_frequency(rows: DataFrame, frequency: DataFrame, total: int) -> DataFrame:
    """``rows`` with the frequency ``n`` of their skill; ``total``: number of all occurrences.

    Skills with more than one in ``HEAVY`` of all occurrences number at most ``HEAVY``: they are broadcast, so
    no partition gets all rows of a common skill.
    """
    heavy = F.col("n") * HEAVY > total
    known = rows.join(F.broadcast(frequency.filter(heavy)), "skill", "left")
    light = known.filter(F.col("n").isNull()).drop("n").join(frequency.filter(~heavy), "skill")
    return known.filter(F.col("n").isNotNull()).unionByName(light)


def _common_last(sets: DataFrame, common_above: int) -> DataFrame:
    """``sets`` with skills in an order that holds for all sets: by value, those of more sets than given last, rarest first.

    Only occurrences of common skills are regrouped; sets without any keep their (ascending) skills and stay in place
    when few others have some.
    """
    exploded = sets.select("side", "set_id", F.explode("skills").alias("skill"))
    common = exploded.groupBy("skill").agg(F.count("*").alias("n")).filter(F.col("n") > common_above)
    marked = materialise(
        exploded.join(F.broadcast(common), "skill").groupBy("side", "set_id")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "skill"))), lambda s: s["skill"]).alias("common")))
    reordered = F.concat(F.array_except("skills", "common"), F.col("common"))
    return sets.join(marked, ["side", "set_id"], "left").withColumn(
        "skills", F.when(F.col("common").isNull(), F.col("skills")).otherwise(reordered)).drop("common")


def candidate_sets(
    sets: DataFrame, min_score: float, common_above: int = COMMON_ABOVE, pairs_at_once: int = PAIRS_AT_ONCE
) -> DataFrame:
    """Distinct (job_set, resume_set) numbers of the ``side, set_id, skills`` rows that may reach the score.

    ``skills`` are in ascending order, ``set_id`` is unique per side.  Pairs of skills are joined in rounds of about
    ``pairs_at_once`` rows, so their shuffle does not grow with the table.
    """
    eps, score = F.lit(1e-9), F.lit(min_score)  # eps keeps ceil and floor exact where the product is a whole number
    overlap = lambda a, b: F.ceil(score / (1 + score) * (a + b) - eps).cast("int")
    depth = lambda size, partner: size - F.greatest(overlap(size, partner), F.lit(2)) + 2
    size = F.size("skills")
    smallest = F.ceil(size * score - eps).cast("int")
    n_pairs = F.when(size < PAIRED_BELOW, depth(size, smallest).cast("long") * (depth(size, smallest) - 1) / 2)
    spans = {row["side"]: row for row in sets.filter(size > 0).groupBy("side").agg(
        F.min(size).alias("least"), F.max(size).alias("most"), F.sum(size).alias("total"), F.sum(n_pairs).alias("pairs")).collect()}
    if len(spans) < 2:
        number = next(f.dataType for f in sets.schema if f.name == "set_id")
        return sets.sparkSession.createDataFrame([], StructType().add("job_set", number).add("resume_set", number))
    total = sum(row["total"] for row in spans.values())
    partners = lambda name: F.when(F.col("side") == "job", spans["resume"][name]).otherwise(spans["job"][name])
    sized = sets.select(
        "side", "set_id", "skills", size.alias("size"),
        F.greatest(smallest, partners("least")).alias("smallest"),
        F.least(F.floor(size / score + eps), partners("most")).cast("int").alias("largest"),
    ).filter((F.col("size") > 0) & (F.col("smallest") <= F.col("largest")))
    by_side = lambda rows, name: rows.filter(F.col("side") == name).select(
        "key", *(F.col(c).alias(f"{name}_{c.removesuffix('_id')}") for c in rows.columns if c not in ("side", "key")))

    # Pairs of skills: two of them are in the size - overlap + 2 first of both sets.  A set comes once per pair, for all
    # partner sizes; which of its pairs count for a partner is known when they meet.
    small = sized.filter(
        (F.col("size") < PAIRED_BELOW) & (F.col("smallest") < PAIRED_BELOW)
        & (overlap(F.col("size"), F.least("largest", F.lit(PAIRED_BELOW - 1))) >= 2))
    first = _common_last(small, max(common_above, total // COMMON_SKILLS)).select(
        "side", "set_id", "size", F.slice("skills", F.lit(1), depth(F.col("size"), F.col("smallest"))).alias("skills"))
    seconds = first.select("*", F.posexplode("skills").alias("last", "second"))
    twos = seconds.select(
        "side", "set_id", "size", "last", "second", F.explode(F.slice("skills", F.lit(1), F.col("last"))).alias("first")
    ).select(F.xxhash64("first", "second").alias("key"), "side", "set_id", "size", "last")
    needed = overlap(F.col("job_size"), F.col("resume_size"))
    counts = F.least("job_size", "resume_size") >= F.greatest("job_size", "resume_size") * score - eps
    for name in ("job", "resume"):
        counts &= F.col(f"{name}_last") <= F.col(f"{name}_size") - needed + 1
    rounds = 1 + int(sum(row["pairs"] or 0 for row in spans.values())) // pairs_at_once
    found = []
    for turn in range(rounds):  # each pair of skills in one of them
        some = twos.filter(F.pmod("key", F.lit(rounds)) == turn) if rounds > 1 else twos
        # Never a broadcast: the estimate of a size does not know how many rows come of a set.
        met = join_large(by_side(some, "job"), by_side(some, "resume"), "key").filter(counts).select("job_set", "resume_set")
        found.append(materialise(met) if rounds > 1 else met)

    # Single skills, rarest first (the order is total), per band of partner sizes: where one common skill is enough, or
    # a set is large.
    large = sized.filter(
        (F.col("size") >= PAIRED_BELOW) | (F.col("largest") >= PAIRED_BELOW) | (overlap(F.col("size"), F.col("smallest")) < 2))
    exploded = large.select("side", "set_id", "size", "smallest", "largest", F.explode("skills").alias("skill"))
    frequency = exploded.groupBy("skill").agg(F.count("*").alias("n"))
    ordered = _with_frequency(exploded, frequency, total).groupBy("side", "set_id", "size", "smallest", "largest").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("n", "skill"))), lambda s: s["skill"]).alias("skills"))
    banded = ordered.select(
        "side", "set_id", "size", "skills", _band(F.col("size")).alias("band"),
        F.explode(F.array_distinct(F.transform(F.sequence("smallest", "largest"), _band))).alias("partner"))
    least = overlap(F.col("size"), F.col("partner"))
    rarest = banded.filter(
        (F.greatest("band", "partner") >= PAIRED_BELOW) | (least < 2)
    ).select("side", "set_id", "band", "partner", F.explode(
        F.slice("skills", F.lit(1), F.greatest(F.col("size") - least + 1, F.lit(0)))).alias("skill"))
    bands = (F.when(F.col("side") == name, F.col("band")).otherwise(F.col("partner")) for name in ("job", "resume"))
    ones = rarest.select(F.xxhash64(*bands, "skill").alias("key"), "side", "set_id")
    shared = join_large(by_side(ones, "job"), by_side(ones, "resume"), "key")
    return reduce(DataFrame.unionByName, found, shared.select("job_set", "resume_set")).distinct()


def skillset_matches(
    job_skills: DataFrame, resume_skills: DataFrame, job_id: str, resume_id: str, min_score: float
) -> DataFrame:
    """Pairs of advert and résumé skill sets with Jaccard score ≥ ``min_score``, exactly.

    Inputs are (id, skill) rows.  Equal sets are matched once and carry the number of adverts
    and résumés that have them.  Two sets of sizes a and b that reach the score s share at least
    o = s / (1 + s) * (a + b) skills, hence one of their a - o + 1 and b - o + 1 rarest ones; only
    those are joined, separately per band of partner sizes.  A skill that most sets have is the last
    in this order and is joined only where nothing rarer can decide.

    Where o is 2 or more, the a - o + 2 and b - o + 2 rarest skills of both have even two in common.  Small sets are
    joined on these pairs of skills, which leaves few candidates that share a skill by chance.  Here only common skills
    are ordered by how rare they are.

    Only hashes of skills and numbers of sets travel through the candidate join; the sets come back for the distinct
    candidates, and decide.
    The sets and the candidates are written to the shared folder once each, and the shuffles before are deleted as soon
    as that is done.  The number of results is not bounded by the input: a low ``min_score`` asks for many pairs.
    """
    if not 0 < min_score <= 1:
        raise ValueError("min_score must be in (0, 1]")
    eps = F.lit(1e-9)  # keeps >= exact
    score = F.lit(min_score)

    def distinct_sets(rows: DataFrame, row_id: str) -> DataFrame:
        whole = rows.groupBy(F.col(row_id).alias("id")).agg(F.sort_array(F.collect_set("skill")).alias("skills"))
        sets = whole.groupBy("skills").agg(F.count("*").alias("members"))
        return materialise(sets.withColumn("set_id", F.monotonically_increasing_id()))  # fixed by being written

    with settings(job_skills.sparkSession, STEP_CONF):
        sets = {"job": distinct_sets(job_skills, job_id), "resume": distinct_sets(resume_skills, resume_id)}
        job, resume = (rows.select(F.lit(name).alias("side"), "set_id", "skills") for name, rows in sets.items())
        pairs = materialise(candidate_sets(job.unionByName(resume), min_score))
    side = lambda name: sets[name].select(
        F.col("set_id").alias(f"{name}_set"), F.col("skills").alias(f"{name}_skills"), F.col("members").alias(f"n_{name}s"))
    shared = F.size(F.array_intersect("job_skills", "resume_skills"))
    together = F.size("job_skills") + F.size("resume_skills") - shared
    return (
        pairs.join(side("job"), "job_set").join(side("resume"), "resume_set")
        .select("job_skills", "resume_skills", "n_jobs", "n_resumes", shared.alias("n_shared"), (shared / together).alias("score"))
        .filter(F.col("score") >= score - eps)
    )


def certificates_by_role(jobs: DataFrame, roles: DataFrame, title: str = "job_title") -> DataFrame:
    """Certificates suggested for each advertised title, with the number of adverts."""
    adverts = jobs.groupBy(title).agg(F.count("*").alias("n_jobs"))
    suggested = roles.select(title, F.explode("certificates").alias("certificate")).distinct()
    return adverts.join(suggested, title, "inner")


def unseen(df: DataFrame, seen: DataFrame, key: str = "url") -> DataFrame:
    """Rows whose key is not in ``seen``, each key as often as it comes."""
    return df.join(seen.select(key), key, "left_anti")


def bucketed_table(df: DataFrame, name: str, key: str, buckets: int) -> None:
    """Save a table bucketed and sorted by its join key, so later joins on it need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(name)

