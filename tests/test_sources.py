import pytest
from pyspark.sql import functions as F

from streamfuse import schemas
from streamfuse.config import Endpoint
from streamfuse.operators import dedup, events
from streamfuse.sources import feeds, routing

A, B, C = (Endpoint(f"https://{x}.example") for x in "abc")


def test_merge_keeps_every_row_and_tags_it(spark):
    one = spark.range(3).withColumn("only_here", F.lit("x"))
    two = spark.range(2)
    feed = feeds.fan_in([(A, one), (B, two), (B, two)])
    got = sorted((r.client_id, r.endpoint, r.ordinal, r.id, r.only_here) for r in feed.collect())
    assert len(got) == 7
    assert got[0] == ("client-1", A.url, 1, 0, "x")
    assert got[-1] == ("client-3", B.url, 3, 1, None)


def test_missing_sources_are_skipped_only_on_request(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "there"))
    sources = [(A, str(tmp_path / "gone")), (B, str(tmp_path / "there"))]
    with pytest.warns(UserWarning, match="a.example skipped"):
        feed = feeds.fan_in(sources, spark, require_any=True)
    assert {r.client_id for r in feed.collect()} == {"client-2"} and feed.count() == 4
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        feeds.fan_in(sources, spark)
    spark.range(2).createOrReplaceTempView("there_too")
    named = [(A, "not_there"), (B, "there_too")]
    with pytest.warns(UserWarning, match="TABLE_OR_VIEW_NOT_FOUND"):
        assert feeds.fan_in(named, spark, require_any=True).count() == 2
    with pytest.warns(UserWarning), pytest.raises(ValueError, match="no usable source"):
        feeds.fan_in(sources[:1], spark, require_any=True)
    with pytest.raises(ValueError, match="no usable source"):
        feeds.fan_in([])


def deliveries(spark):
    body = (b"sig", False, ([b"sig"], None))
    transaction = (body, 7, '{"err":null}', ["program"], {"extra": "1"})
    no_signature = ((None, False, None), 8, None, None, None)
    empty_signature = ((b"", False, None), 9, None, None, None)
    rows = [
        ("client-1", A.url, 1, 1, 100, transaction, None),
        ("client-2", B.url, 2, 1, 105, transaction, (4,)),
        ("client-1", A.url, 1, 2, 110, None, (5,)),
        ("client-1", A.url, 1, 3, 120, None, None),
        ("client-1", A.url, 1, 4, 130, no_signature, None),
        ("client-1", A.url, 1, 5, 140, empty_signature, None),
    ]
    return spark.createDataFrame([(*r, None, "confirmed") for r in rows], schemas.DELIVERY)


@pytest.mark.parametrize("streaming", [False, True])
def test_stored_deliveries_through_the_whole_path(spark, tmp_path, streaming):
    deliveries(spark).write.parquet(str(tmp_path / "in"))
    feed = feeds.read_deliveries(spark, str(tmp_path / "in"), streaming=streaming)
    assert feed.isStreaming == streaming
    routed = routing.flatten_transactions(routing.transactions_only(routing.route(feed)))
    valid = routing.valid_signature(routed)
    if streaming:
        query = valid.writeStream.format("memory").queryName("valid").trigger(availableNow=True)
        query.option("checkpointLocation", str(tmp_path / "cp")).start().awaitTermination()
        valid = spark.table("valid")
    assert sorted((r.ordinal, r.seq, bytes(r.signature), r.slot) for r in valid.collect()) == [
        (1, 1, b"sig", 7),
        (1, 5, b"", 9),
        (2, 1, b"sig", 7),
    ]
    if not streaming:
        judged = dedup.dedup_ttl(valid, "signature", "received_ms", 60)
        unique, duplicates = dedup.split_unique(judged)
        made = events.transaction_events(unique, ["slot", "transaction"]).collect()
        assert sorted((r.signature, r.source, r.timestamp, r.data.slot) for r in made) == [
            ("", A.url, 140, 9),
            (made_signature(b"sig"), A.url, 100, 7),
        ]
        gone = events.duplicate_events(duplicates).collect()
        assert [(r.source, r.timestamp) for r in gone] == [(B.url, 105)]


def made_signature(value):
    from tests.test_functions import plain

    return plain(value)


def test_kinds(spark):
    got = {(r.ordinal, r.seq): r.kind for r in routing.route(deliveries(spark)).collect()}
    assert got == {
        (1, 1): "transaction",
        (2, 1): "transaction",  # both payloads
        (1, 2): "pong",
        (1, 3): "other",
        (1, 4): "transaction",
        (1, 5): "transaction",
    }


def test_json_topic_needs_options_or_a_path(spark):
    with pytest.raises(ValueError):
        feeds.read_deliveries(spark)


def test_event_log_keeps_the_rest_of_each_row(spark):
    pool = spark.createDataFrame([("connected", 5)], "status string, timestamp bigint")
    dup = spark.createDataFrame([("ab", "x", 6)], "sig string, source string, timestamp bigint")
    got = events.event_log({"POOL": pool, "DUPLICATE": dup}).collect()
    assert sorted(tuple(r) for r in got) == [
        ("DUPLICATE", 6, '{"sig":"ab","source":"x"}'),
        ("POOL", 5, '{"status":"connected"}'),
    ]


def test_a_file_that_breaks_loses_its_own_rows_only(spark, tmp_path):
    paths = [tmp_path / f"s{i}" for i in range(3)]
    for i, path in enumerate(paths):
        spark.range(100 * i, 100 * i + 100).repartition(4).write.parquet(str(path))
    broken = sorted(paths[1].glob("*.parquet"))[0]
    lost = spark.read.parquet(str(broken)).count()
    broken.write_bytes(broken.read_bytes()[: broken.stat().st_size // 2])
    (paths[1] / f".{broken.name}.crc").unlink()
    sources = list(zip((A, B, C), map(str, paths), strict=True))
    with pytest.raises(Exception, match="FAILED_READ_FILE|not a Parquet"):
        feeds.fan_in(sources, spark, require_any=True).collect()
    feed = feeds.fan_in(sources, spark, require_any=True, skip_broken=True)
    got = {r.client_id: r["count"] for r in feed.groupBy("client_id").count().collect()}
    assert got == {"client-1": 100, "client-2": 100 - lost, "client-3": 100} and lost > 0
    (line,) = feeds.lost_files(sources, spark).collect()
    assert (line.client_id, line.endpoint, line.bytes) == ("client-2", B.url, broken.stat().st_size)
    assert line.file.endswith(broken.name)


def test_missing_and_unreadable_sources_have_one_line_each(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "good"))
    spark.createDataFrame([("no Parquet",)], "value string").write.text(str(tmp_path / "text"))
    sources = [(A, str(tmp_path / "gone")), (B, str(tmp_path / "good")), (C, str(tmp_path / "text"))]
    with pytest.warns(UserWarning):
        feed = feeds.fan_in(sources, spark, require_any=True, skip_broken=True)
    assert [r.client_id for r in feed.select("client_id").distinct().collect()] == ["client-2"]
    got = {(r.client_id, r.file) for r in feeds.lost_files(sources, spark).collect()}
    assert got == {("client-1", None), ("client-3", None)}


@pytest.mark.parametrize("streaming", [False, True])
def test_payload_stored_as_variants(spark, tmp_path, streaming):
    body = (b"sig", False, ([b"sig"], '{"accountKeys":["a","b"]}'))
    rows = [
        (1, (body, 7, '{"err":{"code":1},"fee":5}', None, {"x": "[1,2]"})),
        (2, ((b"t", True, ([], "no json")), 8, None, None, None)),
        (3, None),
    ]
    full = [("client-1", A.url, 1, i, 100, t, None, None, "confirmed") for i, t in rows]
    texts = spark.createDataFrame(full, schemas.DELIVERY)
    routing.with_variants(texts).write.parquet(str(tmp_path / "in"))
    feed = feeds.read_deliveries(spark, str(tmp_path / "in"), schema=schemas.STORED_DELIVERY, streaming=streaming)
    flat = routing.flatten_transactions(feed)
    flat = flat.select(
        "seq", "account_keys", "failed", F.try_variant_get("meta", "$.fee", "bigint").alias("fee"),
        F.try_variant_get(F.try_element_at("transaction.extra", F.lit("x")), "$[1]", "int").alias("x"),
    )
    if streaming:
        query = flat.writeStream.format("memory").queryName("variants").trigger(availableNow=True)
        query.option("checkpointLocation", str(tmp_path / "cp")).start().awaitTermination()
        flat = spark.table("variants")
    assert sorted(map(tuple, flat.collect())) == [(1, ["a", "b"], True, 5, 2), (2, None, False, None, None), (3, None, None, None, None)]
    same = routing.flatten_transactions(texts).select("seq", "account_keys", "failed")
    assert sorted(map(tuple, same.collect())) == sorted((r[0], r[1], r[2]) for r in flat.collect())
