"""Joins and checks on the series, concept and entity dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the form of a series id.
ID = r"^[a-z][a-z0-9_]*:[A-Za-z0-9][A-Za-z0-9_./\-]*$"


def resolve_alias(ids: DataFrame, series: DataFrame) -> DataFrame:
    """``ids`` with ``canonical``: the id itself where it exists, the series that has it as an alias, else the id."""
    own = series.select(F.col("series_id").alias("given"), F.lit(None).cast("string").alias("of"))
    alias = series.select(F.explode("aliases").alias("given"), F.col("series_id").alias("of"))
    names = own.unionByName(alias).groupBy("given").agg(F.bool_or(F.col("of").isNull()).alias("is_id"), F.min("of").alias("of"))
    return ids.join(names, ids["series_id"] == names["given"], "left").select(*[ids[c] for c in ids.columns], F.when(F.coalesce("is_id", F.lit(True)), ids["series_id"]).otherwise(F.col("of")).alias("canonical"))


def resolve(keys: DataFrame, series: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entity_id, key) to series ids; ``key`` is a concept of the entity, or a series id that belongs to it.

    Also returns (entity_id, key, error) of what can't be resolved, with the entities that have the concept.
    """
    keys = keys.select("entity_id", "key")
    by_concept = series.where("concept_id IS NOT NULL").select("entity_id", F.col("concept_id").alias("key"), "series_id")
    by_id = series.select(F.col("entity_id").alias("_entity"), F.col("series_id").alias("key"), F.col("series_id").alias("_id"))
    rows = keys.join(by_concept, ["entity_id", "key"], "left").join(by_id, "key", "left")
    right = F.col("_id").isNotNull() & (F.col("entity_id").isNull() | (F.col("entity_id") == F.col("_entity")))
    rows = rows.withColumn("found", F.coalesce("series_id", F.when(right, F.col("_id"))))
    where = series.groupBy(F.col("concept_id").alias("key")).agg(F.array_join(F.array_sort(F.collect_set("entity_id")), ",").alias("entities"))
    lost = rows.where("found IS NULL").join(where, "key", "left")
    error = F.when(F.col("_id").isNotNull(), F.concat(F.lit("series belongs to "), F.col("_entity"))).when(F.col("entities").isNotNull(), F.concat(F.lit("concept is known for "), F.col("entities"))).otherwise("unknown key")
    return rows.where("found IS NOT NULL").select("entity_id", "key", F.col("found").alias("series_id")), lost.select("entity_id", "key", error.alias("error"))


def concepts(series: DataFrame, entity: str) -> DataFrame:
    return series.where((F.col("entity_id") == entity) & F.col("concept_id").isNotNull()).select("concept_id").distinct().orderBy("concept_id")


def entities_with(series: DataFrame, concept: str) -> DataFrame:
    return series.where(F.col("concept_id") == concept).select("entity_id").distinct().orderBy("entity_id")


def search(series: DataFrame, text: str) -> DataFrame:
    """Series whose id, title, concept or unit contains a text, whatever its case."""
    hit = F.lit(False)
    for c in ("series_id", "title", "concept_id", "unit"):
        hit = hit | F.coalesce(F.contains(F.lower(c), F.lit(text.lower())), F.lit(False))
    return series.where(hit).orderBy("series_id")


def list_series(series: DataFrame, source: str | None = None) -> DataFrame:
    return (series.where(F.col("source") == source) if source is not None else series).orderBy("source", "series_id")


def describe(series: DataFrame, obs: DataFrame) -> DataFrame:
    """Catalog rows with their coverage."""
    span = obs.where("realtime_end IS NULL").groupBy("series_id").agg(F.min("period").alias("first_open"), F.max("period").alias("last_open"), F.count("value").alias("n_values"))
    return series.join(span, "series_id", "left")


def catalog_violations(series: DataFrame, known_concepts: DataFrame, entities: DataFrame) -> DataFrame:
    """(violation, subject) for everything that is wrong with the dimensions."""
    def named(df: DataFrame, violation: str, subject) -> DataFrame:
        return df.select(F.lit(violation).alias("violation"), subject.cast("string").alias("subject"))

    alias = series.select("series_id", F.explode("aliases").alias("alias"))
    return (
        named(series.groupBy("series_id").count().where("count > 1"), "repeated id", F.col("series_id"))
        .unionByName(named(series.where(~F.col("series_id").rlike(ID)), "malformed id", F.col("series_id")))
        .unionByName(named(alias.join(series.select(F.col("series_id").alias("alias")).distinct(), "alias", "left_semi"), "alias is an id", F.col("alias")))
        .unionByName(named(alias.groupBy("alias").agg(F.countDistinct("series_id").alias("n")).where("n > 1"), "alias of several series", F.col("alias")))
        .unionByName(named(series.where("concept_id IS NOT NULL").join(known_concepts.select("concept_id"), "concept_id", "left_anti"), "undefined concept", F.col("series_id")))
        .unionByName(named(series.join(entities.select("entity_id"), "entity_id", "left_anti"), "undefined entity", F.col("series_id")))
        .unionByName(named(series.where("concept_id IS NOT NULL").groupBy("entity_id", "concept_id").count().where("count > 1"), "concept mapped twice", F.concat_ws("@", "concept_id", "entity_id")))
    )


def missing_ids(baseline: DataFrame, series: DataFrame) -> DataFrame:
    """Ids of a baseline that are neither ids nor aliases any more."""
    known = series.select("series_id").unionAll(series.select(F.explode("aliases")))
    return baseline.select("series_id").distinct().join(known, "series_id", "left_anti")


def fingerprint(df: DataFrame) -> DataFrame:
    """One row that changes when any row does, whatever the order: the rows' count, and two mixes of their digests."""
    digest = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
    half = lambda k: F.conv(F.substring("d", 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)")
    return df.select(digest.alias("d")).agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(half(0)), F.lit(0).cast("decimal(38,0)")).alias("sum_a"), F.coalesce(F.sum(half(1)), F.lit(0).cast("decimal(38,0)")).alias("sum_b"))
