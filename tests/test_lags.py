import datetime as dt


from tidemill.operators.rules import payment_lag
from tidemill.streaming import sinks
from tidemill.streaming.lags import payment_lag_stream

ORDERS = "order_id string, order_date timestamp"
PAYMENTS = "payment_id string, order_id string, created_at timestamp"
START = dt.datetime(2024, 1, 1, 10)


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


def test_pairs_equal_the_batch_and_late_rows_are_dropped(spark, tmp_path):
    folder = {name: f"{tmp_path}/{name}" for name in ("orders", "payments", "out", "checkpoint")}

    def arrive(orders, payments):
        """Rows come in, and a run of the stream takes them."""
        for name, rows, schema in (("orders", orders, ORDERS), ("payments", payments, PAYMENTS)):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder[name])
        streams = [spark.readStream.schema(s).parquet(folder[n]) for n, s in (("payments", PAYMENTS), ("orders", ORDERS))]
        query = payment_lag_stream(*streams).writeStream.format("parquet").option("checkpointLocation", folder["checkpoint"])
        query = query.trigger(**sinks.ONCE).start(folder["out"])
        query.awaitTermination()
        held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
        found = spark.read.schema("payment_id string, order_id string, lag_minutes long").parquet(folder["out"])
        return sorted(map(tuple, found.collect())), held[-1]

    # Payments before their orders, too late after them, in time, and of no order.
    found, _ = arrive(
        [("a", at(0)), ("b", at(5)), ("n", None)],
        [("p1", "a", at(10)), ("p2", "a", at(-1)), ("p3", "b", at(66)), ("p4", "x", at(3)), ("p5", "c", at(50)), ("p0", "n", None)],
    )
    assert found == [("p1", "a", 10)]
    # An order that comes after its payment, within the lateness.
    found, _ = arrive([("c", at(20))], [("p6", "b", at(65))])
    assert found == [("p1", "a", 10), ("p5", "c", 30), ("p6", "b", 60)]
    batch = payment_lag(spark.read.schema(PAYMENTS).parquet(folder["payments"]), spark.read.schema(ORDERS).parquet(folder["orders"]))
    assert found == sorted(map(tuple, batch.collect()))
    # Two days later, nothing old is held, and what comes for it is dropped.
    day = 2 * 24 * 60
    found, held = arrive([("d", at(day))], [("p7", "d", at(day + 1))])
    assert ("p7", "d", 1) in found and held <= 2
    found, _ = arrive([("e", at(30))], [("p8", "a", at(20)), ("p9", "d", at(day + 2)), ("p10", "e", at(31))])
    assert {p for p, *_ in found} == {"p1", "p5", "p6", "p7", "p9"}
