"""Marts that follow the ODS: replaced and deleted offers leave them (A9 -> D1-D3, G1).

The append marts count every fact row, so a document that is read again weighs more. Here
each run adds signed deltas instead: +1 for an offer it inserts, -1 for the offer that this
insert replaces or that a deletion takes away. Sums of prices, counts and reference counts
of airports all add up over runs; a group or airport whose count comes to 0 is gone. Prices
are whole numbers, so taking back is exact.

What a run replaces is found in keyed state (``keyed_state``): the offers of every document,
narrow, by hash bucket of the document. A run reads the buckets of its documents only.

Tables under the state root: ``offer_state``, ``mart_deltas``, ``airport_deltas``,
``ods_deletes`` (by run) and ``live_*`` (whole tables).

Defined cases: an offer without link never matches another, as in delete+insert, and leaves
by deletion only; several equal keys in one run all count; an offer without price counts
for the group, not for its mean; a run that was not taken is caught up with the next one; a
run taken again replaces its own deltas.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.operators import marts
from farelake.plans import incremental as inc
from farelake.plans import keyed_state

OFFERS = "offer_state"
GROUP = ["search_date", "departure_date", *marts.ROUTE]
OFFER_COLUMNS = ["doc_id", "link", *GROUP, "origin_airport", "destination_airport", "price_rub"]
LIVE = {"agg_route": "live_agg_route", "agg_dep_route": "live_agg_dep_route",
        "agg_search_dep_route": "live_agg_search_dep_route", "airports": "live_airports"}


def offers_of(ods: DataFrame) -> DataFrame:
    """The columns of ODS rows that the marts need, and ``run_id``."""
    return ods.withColumn("departure_date", F.to_date("departure_at_utc")).select(*OFFER_COLUMNS, "run_id")


def price_deltas(offers: DataFrame) -> DataFrame:
    """Signed sums by search day, departure day and route; offers carry ``sign``."""
    sign = F.col("sign")
    return offers.groupBy(*GROUP).agg(
        F.sum(sign * F.col("price_rub")).alias("price_sum"),
        F.sum(F.when(F.col("price_rub").isNotNull(), sign).otherwise(0)).alias("price_n"), F.sum(sign).alias("offers"))


def airport_deltas(offers: DataFrame) -> DataFrame:
    """Signed references of (airport, city) pairs; both pairs of an offer in one pass."""
    pairs = F.array(F.struct(F.col("origin_airport").alias("airport_code"), F.col("origin").alias("city_code")),
                    F.struct(F.col("destination_airport").alias("airport_code"), F.col("destination").alias("city_code")))
    return offers.select("sign", F.explode(pairs).alias("p")).groupBy("p.airport_code", "p.city_code").agg(F.sum("sign").alias("refs"))


def add_prices(deltas: DataFrame) -> DataFrame:
    """Deltas of several runs as one row a group; groups without offers are gone."""
    return deltas.groupBy(*GROUP).agg(
        F.sum("price_sum").alias("price_sum"), F.sum("price_n").alias("price_n"), F.sum("offers").alias("offers")).filter("offers > 0")


def add_airports(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy("airport_code", "city_code").agg(F.sum("refs").alias("refs")).filter("refs > 0")


def current_offers(state: DataFrame) -> DataFrame:
    """Offers that hold: the newest insert of each key after its document's last deletion."""
    deleted = state.filter("gone").groupBy("doc_id").agg(F.max("run_id").alias("_deleted"))
    rows = state.filter("not gone").join(deleted, "doc_id", "left").filter(
        F.col("_deleted").isNull() | (F.col("run_id") > F.col("_deleted"))).drop("_deleted", "gone")
    return inc.newest_inserts(rows, inc.ODS_KEYS)


def take_run(spark: SparkSession, root: str, run_id: int, deleted: DataFrame | None = None) -> None:
    """Deltas of a run: of the ODS inserts since the last run taken, and of deleted documents."""
    taken = inc.last_run(spark, root, "live", run_id)
    inserts = inc.read_if_exists(spark, f"{root}/ods")
    inserts = inc.read_runs_of(spark, f"{root}/ods").limit(0) if inserts is None else inserts
    inserts = inserts.filter((F.col("run_id") > taken) & (F.col("run_id") <= run_id))
    new = inc.newest_inserts(offers_of(inserts), inc.ODS_KEYS).drop("run_id")
    keys = new.select("doc_id", "link").distinct()
    docs = keys.select("doc_id")
    if deleted is not None:
        docs = docs.unionByName(deleted.select("doc_id"))
    state = keyed_state.read_state(spark, root, OFFERS, keyed_state.batch_buckets(docs, root), before=run_id)
    signed = new.withColumn("sign", F.lit(1))
    gone = new.limit(0)
    if state is not None:
        now = current_offers(state)
        old = now.join(keys.filter("doc_id is not null and link is not null"), ["doc_id", "link"], "left_semi")
        if deleted is not None:
            ids = deleted.select("doc_id").distinct()
            old = old.join(ids, "doc_id", "left_anti").unionByName(now.join(ids, "doc_id", "left_semi"))
        signed = signed.unionByName(old.select(*OFFER_COLUMNS).withColumn("sign", F.lit(-1)))
    if deleted is not None:
        gone = deleted.select("doc_id").distinct().select(
            "doc_id", *[F.lit(None).cast(new.schema[c].dataType).alias(c) for c in OFFER_COLUMNS[1:]])
    inc.write_run(price_deltas(signed), f"{root}/mart_deltas", run_id)
    inc.write_run(airport_deltas(signed), f"{root}/airport_deltas", run_id)
    keyed_state.write_state(new.withColumn("gone", F.lit(False)).unionByName(gone.withColumn("gone", F.lit(True))),
                            root, OFFERS, run_id)
    inc.set_watermark(spark, root, "live", run_id, inserts, "processed_src_dttm")


def refresh(spark: SparkSession, root: str, run_id: int) -> None:
    """The live marts from the deltas of all runs; no offer is read."""
    sums = add_prices(inc.read_runs_of(spark, f"{root}/mart_deltas"))
    refs = add_airports(inc.read_runs_of(spark, f"{root}/airport_deltas"))
    for name, df in [*marts.from_sums(sums).items(), ("airports", refs.select("airport_code", "city_code"))]:
        inc.write_table(df, root, LIVE[name], run_id)


def read_live(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One of the live marts: agg_route, agg_dep_route, agg_search_dep_route, airports."""
    return inc.read_table_model(spark, root, LIVE[name])


def run_live(spark: SparkSession, root: str, docs: DataFrame, run_id: int, processed_at=None, **run_kw) -> None:
    """An increment (``run_increment``) whose live marts follow."""
    inc.run_increment(spark, root, docs, run_id, processed_at, with_marts=False, **run_kw)
    if inc.list_paths(spark, f"{root}/ods/run_id=*"):
        take_run(spark, root, run_id)
        refresh(spark, root, run_id)


def delete_documents(spark: SparkSession, root: str, ids: DataFrame, run_id: int, load_time=None,
                     source: str | None = None) -> None:
    """Take documents out of the ODS and the live marts, as a run of its own. ids: ``doc_id``.

    Their versions stay in the log and their rows in the fact, which are histories; a later
    version of such a document enters the ODS again.
    """
    load_time = inc.instant(spark, load_time)
    stage = f"{root}/_staging/delete={run_id}"
    ids.select("doc_id").filter("doc_id is not null").distinct().write.mode("overwrite").parquet(stage)
    batch = spark.read.schema("doc_id string").parquet(stage)
    mark = inc.batch_mark(batch)
    try:
        status, load_time = inc.begin_run(spark, root, run_id, mark, load_time, source)
        if status == "done":
            return
        inc.write_run(batch, f"{root}/ods_deletes", run_id)
        take_run(spark, root, run_id, batch)
        refresh(spark, root, run_id)
        inc.write_run_row(spark, root, run_id, (source, load_time, *mark, "done"))
    finally:
        inc.remove_path(spark, stage)


def catch_up(spark: SparkSession, root: str, last: int) -> None:
    """Take the runs up to ``last`` that the live marts, if there are any, have not taken."""
    if inc.path_exists(spark, f"{root}/mart_deltas") and inc.last_run(spark, root, "live", last + 1) < last:
        take_run(spark, root, last)
        refresh(spark, root, last)


def compact(spark: SparkSession, root: str, last: int, vacuum: bool) -> None:
    """Merge what the runs left; called by ``incremental.compact``."""
    for table, merge in (("mart_deltas", add_prices), ("airport_deltas", add_airports)):
        if inc.compacted_through(spark, f"{root}/{table}") != last and inc.path_exists(spark, f"{root}/{table}"):
            inc.write_base(merge(inc.read_runs_of(spark, f"{root}/{table}")), root, table, last, vacuum)
    if inc.compacted_through(spark, f"{root}/{OFFERS}") != last and inc.path_exists(spark, f"{root}/{OFFERS}"):
        state = keyed_state.read_state(spark, root, OFFERS)
        keyed_state.compact_state(spark, root, OFFERS, last, current_offers(state).select(*OFFER_COLUMNS, F.lit(False).alias("gone")),
                                  vacuum=vacuum)
