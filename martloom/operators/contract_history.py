"""Which versions of a contract fit all that was published before them.

A version is *backward* compatible if it accepts every message that any earlier version of its
subject accepts, *forward* compatible if every earlier version accepts what it accepts, and *full*
if both. A comparison with all earlier versions, not only the last, holds for topics whose old
messages are still read.

No two versions are compared. What a contract demands falls apart into demands on single
properties, so all earlier versions together ask of a property what running unions, intersections and
counts over its earlier versions say: the types it may have had, whether all versions required it,
how many that allow other properties did not list it. Each is a window over the versions of one
property, linear in their number; types are bits of a number.

Contracts are flat JSON Schemas, as ``functions/contract.py`` reads them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.contract import SPARK_TYPES, value_subject

TYPES = tuple(SPARK_TYPES)
ANY = (1 << len(TYPES)) - 1


def _bits(types: Column) -> Column:
    """A bit for each type that a property may have; a number may be an integer. All, if any."""
    bits = {kind: 1 << at for at, kind in enumerate(TYPES)}
    bits["number"] |= bits["integer"]

    def bit(kind: Column) -> Column:
        chain = F.when(F.lit(False), 0)
        for name in TYPES:
            chain = chain.when(kind == name, bits[name])
        return chain.otherwise(F.raise_error(F.concat(F.lit("unknown JSON type "), kind)).cast("int"))

    united = F.aggregate(types, F.lit(0), lambda found, kind: found.bitwiseOR(bit(kind)))
    return F.coalesce(united, F.lit(ANY))


def read_contracts(versions: DataFrame) -> DataFrame:
    """``subject, version, closed, required, properties`` of ``subject, version, schema`` (text)."""
    parsed = versions.withColumn("__schema", F.parse_json("schema"))
    read = lambda path, kind: F.try_variant_get("__schema", path, kind)
    members = F.map_entries(read("$.properties", "map<string, variant>"))

    def member(one: Column) -> Column:
        get = lambda kind: F.try_variant_get(one["value"], "$.type", kind)
        single = F.when(get("string").isNotNull(), F.array(get("string")))
        types = F.coalesce(get("array<string>"), single)
        return F.struct(one["key"].alias("name"), _bits(types).alias("types"))

    none = F.array().cast("array<struct<name: string, types: int>>")
    return parsed.select(
        "subject",
        "version",
        F.coalesce(~read("$.additionalProperties", "boolean"), F.lit(False)).alias("closed"),
        F.array_distinct(
            F.coalesce(read("$.required", "array<string>"), F.array().cast("array<string>"))
        ).alias("required"),
        F.coalesce(F.transform(members, member), none).alias("properties"),
    )


def contract_history(versions: DataFrame) -> DataFrame:
    """``subject, version, backward, forward, full`` of every version.

    ``versions``: ``subject, version, schema``, each version of a subject once. The versions of a
    subject are ordered in one task, as small rows.
    """
    contracts = read_contracts(versions)
    of_version = Window.partitionBy("subject").orderBy("version")
    before = of_version.rowsBetween(Window.unboundedPreceding, -1)
    of_name = Window.partitionBy("subject", "name").orderBy("version")
    earlier = of_name.rowsBetween(Window.unboundedPreceding, -1)
    sofar = lambda n: F.coalesce(n.over(earlier), F.lit(0))
    count = lambda is_so: F.sum(is_so.cast("long"))
    limited = F.col("types") != ANY

    listed = contracts.select("subject", "version", "closed", F.inline("properties")).select(
        "subject", "version", "name", "types", "closed",
        sofar(F.count(F.lit(1))).alias("listed"),
        sofar(count(~F.col("closed"))).alias("listed_open"),
        sofar(count(F.col("closed"))).alias("listed_closed"),
        sofar(count(limited)).alias("listed_limited"),
        sofar(F.bit_or("types")).alias("may_have_been"),
        F.coalesce(F.bit_and("types").over(earlier), F.lit(ANY)).alias("must_have_been"),
    )
    demanded = contracts.select("subject", "version", F.explode("required").alias("name"))
    demanded = demanded.select("subject", "version", sofar(F.count(F.lit(1))).alias("demanded"))
    totals = contracts.select(
        "subject", "version", "closed",
        F.coalesce(F.count(F.lit(1)).over(before), F.lit(0)).alias("n"),
        F.coalesce(count(F.col("closed")).over(before), F.lit(0)).alias("n_closed"),
    )
    on = ["subject", "version"]
    # Types that an earlier message may have in a property: any, if a version that allows other
    # properties did not list it.
    unlisted = F.col("n") - F.col("n_closed") > F.col("listed_open")
    may_be = F.when(unlisted, F.lit(ANY)).otherwise(F.col("may_have_been"))
    beyond = lambda left, right: left.bitwiseAND(F.bitwise_not(right)) != 0
    by_types = listed.join(totals.drop("closed"), on).groupBy(*on).agg(
        F.count_if(beyond(may_be, F.col("types"))).alias("narrowed"),
        F.count_if(beyond(F.col("types"), F.col("must_have_been"))).alias("widened"),
        F.count_if(F.col("listed_closed") < F.col("n_closed")).alias("added"),
        F.count_if(F.col("listed") > 0).alias("known"),
        F.count_if(F.col("listed") == 0).alias("new"),
        F.count_if(F.col("listed_limited") > 0).alias("known_limited"),
        F.count_if(limited & (F.col("listed_limited") == 0)).alias("new_limited"),
    )
    by_demand = demanded.join(totals.drop("closed"), on).groupBy(*on).agg(
        F.count_if(F.col("demanded") < F.col("n")).alias("newly_required"),
        F.count_if(F.col("demanded") > 0).alias("still_required"),
        F.count_if(F.col("demanded") == 0).alias("first_required"),
    )
    joined = totals.join(by_types, on, "left").join(by_demand, on, "left").na.fill(0)
    past = lambda name: F.coalesce(F.sum(name).over(before), F.lit(0))
    seen = joined.withColumns(
        {
            "all_known": past("new"),
            "all_limited": past("new_limited"),
            "all_required": past("first_required"),
        }
    )
    only_closed = (F.col("n_closed") == F.col("n")) & (F.col("known") == F.col("all_known"))
    backward = (
        (F.col("newly_required") == 0) & (F.col("narrowed") == 0) & (~F.col("closed") | only_closed)
    )
    within = (F.col("n_closed") == 0) | (F.col("closed") & (F.col("added") == 0))
    forward = (
        (F.col("still_required") == F.col("all_required"))
        & (F.col("widened") == 0)
        & (F.col("closed") | (F.col("known_limited") == F.col("all_limited")))
        & within
    )
    return seen.select(
        *on, backward.alias("backward"), forward.alias("forward"), (backward & forward).alias("full")
    )


def topic_history(versions: DataFrame, topic: str) -> DataFrame:
    """The history of one topic's value contract, without the subject."""
    own = versions.where(F.col("subject") == value_subject(topic))
    return contract_history(own).drop("subject")
