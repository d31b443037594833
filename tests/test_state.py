"""The state of the latest-report query, read from its checkpoint: after each batch, after restarts, and against the table."""

import random

import pytest

from contrail.functions.scalars import aircraft_key
from contrail.plans.tables import ARRIVAL_ORDER
from contrail.streaming.pipeline import replay_in_batches, report_stream
from contrail.sources.messages import read_message_files
from contrail.streaming.sinks import KeyedTable
from contrail.streaming.state import latest_state, read_latest_state, start_latest, state_stores
from tests.helpers import flights_df

COLUMNS = ["icao24", "callsign", "velocity", "last_contact", "ingestion_ts"]


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    r = random.Random(6)
    rows = [dict(icao24=r.choice([None, "", *(f"k{r.randrange(60)}" for _ in range(8))]), callsign=r.choice([None, "C1", "C2"]),
                 velocity=r.choice([None, 1.0, 2.0]), last_contact=1000 + i, ingestion_ts=r.choice([None, 1000 + i // 10 * 10])) for i in range(600)]
    flights = flights_df(spark, rows)
    root = str(tmp_path_factory.mktemp("state"))
    table, seen = KeyedTable(f"{root}/latest", ["icao24"], ARRIVAL_ORDER), []

    def once():
        q = start_latest(report_stream(read_message_files(spark, f"{root}/in", recursive=True)), table, f"{root}/ck", COLUMNS, trigger={"availableNow": True}, state_partitions=4)
        q.awaitTermination()
        assert q.exception() is None
        seen.append(state_stores(spark, f"{root}/ck").first().maxBatchId)
    replay_in_batches(spark, flights, f"{root}/in", 4, once)
    return flights, table, f"{root}/ck", seen


def canon(df):
    return sorted(map(str, df.select(*COLUMNS).collect()))


def test_state_equals_the_batch_result_and_the_table_after_restarts(spark, run):
    flights, table, ck, seen = run
    state = canon(read_latest_state(spark, ck, COLUMNS))
    assert len(seen) == 4 and state == canon(latest_state(flights, COLUMNS)) == canon(table.current(spark))


def test_state_of_an_earlier_batch(spark, run):
    flights, _, ck, seen = run
    for part, batch in enumerate(seen[:3], 1):
        upto = flights.where(f"last_contact < {1000 + 150 * part}")
        assert canon(read_latest_state(spark, ck, COLUMNS, batch=batch)) == canon(latest_state(upto, COLUMNS))


def test_stores_and_keys(spark, run):
    flights, _, ck, _ = run
    stores = state_stores(spark, ck).collect()
    assert len(stores) == 1 and stores[0].numPartitions == 4
    keys = [r.icao24 for r in read_latest_state(spark, ck, ["icao24"]).collect()]
    assert sorted(keys) == sorted(r[0] for r in flights.select(aircraft_key("icao24")).distinct().collect())
