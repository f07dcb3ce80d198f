import os

import pytest
from pyspark.sql import functions as F

from fixtures import messages, rows
from jsonstrata.operators.membership import packed_filter
from jsonstrata.queries.frames import one_file_each
from jsonstrata.session import shared_folder
from jsonstrata.sinks import files
from jsonstrata.sinks.signals import archive_payloads
from jsonstrata.sinks.tables import BatchTable
from jsonstrata.sources import dropdir
from jsonstrata.sources.dropdir import eligible, list_files, oldest_first, read_drop_batch
from jsonstrata.sources.envelopes import (
    open_envelopes,
    read_payloads,
    resolve_claim_checks,
    resolved,
    unresolved,
)
from jsonstrata.sources.messages import as_messages, sample_messages, topic_messages, topic_options


def drop(directory, name, text, age):
    """A file that was last changed ``age`` seconds before a fixed time."""
    path = directory / name
    path.write_text(text)
    os.utime(path, (1_700_000_000 - age, 1_700_000_000 - age))


@pytest.fixture
def incoming(tmp_path):
    """The drop directory of the intake rules: limits are ``.json``, 1 to 100 bytes, 2 at a time."""
    folder = tmp_path / "incoming"
    folder.mkdir()
    for i, age in enumerate((300, 200, 100)):
        drop(folder, f"f{i}.json", f'{{"n":\n {i}  }}', age)
    drop(folder, "empty.json", "", 10)
    drop(folder, "big.json", "x" * 101, 10)
    drop(folder, "x.tmp", "{}", 400)
    drop(folder, "f0.json.0a1b2c3d", "{}", 400)
    (folder / "sub").mkdir()
    drop(folder / "sub", "nested.json", "{}", 400)
    return folder


def names(df):
    return [r["name"] for r in df.select(F.substring_index("path", "/", -1).alias("name")).collect()]


def test_eligible_files(spark, incoming):
    listing = list_files(spark, str(incoming))
    assert sorted(names(eligible(listing, max_file_bytes=100))) == ["f0.json", "f1.json", "f2.json"]
    early = F.timestamp_seconds(F.lit(1_700_000_000 - 200 + 4))
    assert names(eligible(listing, early, max_file_bytes=100)) == ["f0.json"]
    assert names(oldest_first(eligible(listing, max_file_bytes=100), 2)) == ["f0.json", "f1.json"]


def test_drop_batch_reads_whole_files_oldest_first(spark, incoming):
    got = read_drop_batch(spark, str(incoming), max_files=2, max_file_bytes=100)
    assert sorted(r["json"] for r in got.collect()) == ['{"n":\n 0  }', '{"n":\n 1  }']
    first = got.where(F.col("source").endswith("f0.json")).first()
    assert first["message_id"] == "hdfs-f0.json-1699999700000"
    assert (first["partition"], first["bytes"]) == (0, 11)
    assert got.select("offset").distinct().count() == 2
    drop(incoming, "a b[1]%20+.json", "{}", 500)
    odd = read_drop_batch(spark, str(incoming), max_files=1).first()
    assert odd["message_id"] == "hdfs-a b[1]%20+.json-1699999500000"
    assert odd["source"].endswith("/incoming/a b[1]%20+.json")
    nothing = read_drop_batch(spark, str(incoming), suffix=".xml")
    assert nothing.count() == 0 and nothing.columns == got.columns


def test_drop_batch_shows_what_it_refuses(spark, incoming):
    got = read_drop_batch(spark, str(incoming), max_files=1, max_file_bytes=100, with_rejected=True).persist()
    name = F.substring_index("source", "/", -1)
    # Spark's file sources pass over empty files, so there is no row for them.
    assert rows(got.select(name, "rejected")) == [("big.json", "file has more than 100 bytes"), ("f0.json", None)]
    rest = read_drop_batch(spark, str(incoming), max_file_bytes=100, taken=got, with_rejected=True)
    assert rows(rest.select(name, "rejected")) == [("f1.json", None), ("f2.json", None)]
    got.unpersist()


def test_topic_source(spark):
    assert topic_options("t", '{"t":{"0":5}}', 1000, {"kafka.bootstrap.servers": "h:1"}) == {
        "subscribe": "t",
        "startingOffsets": '{"t":{"0":5}}',
        "kafka.bootstrap.servers": "h:1",
        "maxOffsetsPerTrigger": "1000",
    }
    assert topic_options("t")["startingOffsets"] == "latest"
    delivered = spark.createDataFrame(
        [(bytearray(b'{"a":"\xc3\xa9"}'), "t", 3, 3000000000)],
        "value binary, topic string, partition int, offset bigint",
    )
    got = topic_messages(delivered)
    assert got.schema.simpleString() == "struct<partition:int,offset:bigint,json:string,source:string>"
    assert rows(got) == [(3, 3000000000, '{"a":"é"}', "t")]


def test_sample_is_the_first_messages(spark):
    assert [(r["partition"], r["offset"]) for r in sample_messages(messages(spark), 3).collect()] == [
        (0, 1),
        (0, 2),
        (0, 3),
    ]


def test_claim_checks(spark, tmp_path):
    folder = tmp_path / "payloads"
    folder.mkdir()
    (folder / "p 1.json").write_text('{\n"a": 1}')
    (folder / "p2.json").write_text('{"a": 2}')
    raw = messages(
        spark,
        [
            (0, 1, '{"a":0}', "t"),
            (0, 2, f'{{"payload_ref":"file://{folder}/p2.json"}}', "t"),
            (0, 3, f'{{"payload_ref":"{folder}/p2.json"}}', "t"),
            (0, 4, f'{{"payload_ref":"{folder}/gone.json"}}', "t"),
            (0, 5, f'{{"payload_ref":"{folder}/p 1.json"}}', "t"),
            (0, 6, "not json", "t"),
        ],
    )
    got = resolve_claim_checks(open_envelopes(raw), read_payloads(spark, str(folder)))
    assert rows(resolved(got).select("offset", "json")) == [
        (1, '{"a":0}'),
        (2, '{"a": 2}'),
        (3, '{"a": 2}'),
        (5, '{\n"a": 1}'),
        (6, "not json"),
    ]
    assert rows(unresolved(got).select("offset", "json", "reason")) == [
        (4, f"{folder}/gone.json", "payload not found")
    ]


def test_payload_scan_reads_only_files_that_are_referred_to(spark, tmp_path):
    folder = tmp_path / "payloads"
    (folder / "day=1").mkdir(parents=True)
    odd = ["c d.json", "e+f.json", "g%20h.json", "ü.json", "h#1.json"]
    for name in ("a.json", "b.json", *odd):
        (folder / "day=1" / name).write_text(name)
    # A file of this size fails a scan that opens it.
    (folder / "day=1" / "never.json").write_text("x" * 100)

    def scanned(refs):
        raw = [(0, i, f'{{"payload_ref":"{folder}/day=1/{ref}"}}', "t") for i, ref in enumerate(refs)]
        envelopes = open_envelopes(messages(spark, raw))
        payloads = read_payloads(spark, str(folder), envelopes)
        found = resolved(resolve_claim_checks(envelopes, payloads))
        return rows(payloads.select("payload")), sorted(r["json"] for r in found.collect())

    limit = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(limit, 50)
    try:
        assert scanned(["a.json", "a.json", "none.json"]) == ([("a.json",)], ["a.json", "a.json"])
        assert scanned(["a.json", *odd]) == (sorted((n,) for n in ["a.json", *odd]), sorted(["a.json", *odd]))
        assert scanned([]) == ([], [])
    finally:
        spark.conf.unset(limit)


def test_packed_filter_holds_every_id(spark):
    ids = spark.range(20_000).select(F.concat(F.lit("n"), "id").alias("name"))
    absent = spark.range(5_000).select(F.concat(F.lit("m"), "id").alias("name"))
    for most, passing in [(100, 0.03), (1, 1.0)]:
        known = packed_filter(ids, "name", most)
        assert ids.where(known(F.col("name"))).count() == 20_000
        assert absent.where(known(F.col("name"))).count() <= passing * 5_000


def test_archive(spark):
    folder = shared_folder(spark)
    for _ in range(2):
        archive_payloads(messages(spark, [(0, 1, '{"a":1}', "t"), (0, 2, None, "t")]), folder, "b-0")
    archive_payloads(messages(spark, [(0, 3, '{"a":2}', "t")]), folder, "b-1")
    assert rows(spark.read.text(folder).select("value")) == [('{"a":1}',), ('{"a":2}',)]


def test_batch_table(spark, prefix):
    folder = shared_folder(spark)
    spark.sql(f"CREATE DATABASE {prefix}db LOCATION '{folder}'")
    table = BatchTable(f"{prefix}db.t", f"{folder}/t", keys=("tag",))
    one = spark.createDataFrame([(1, (2, "x"))], "`a b` int, s struct<`c-d`:int, e:string>")
    assert table.write(one, "b-0", {"tag": "p"}) == 1
    assert table.write(one.unionByName(one), "b-1", {"tag": "p"}) == 2
    assert table.write(one, "b-0", {"tag": "q"}) == 1
    assert table.write(one.where("false"), "b-0", {"tag": "q"}) == 0
    assert table.read(spark).count() == 3
    assert table.read(spark, without_batch="b-1").count() == 1
    assert table.read(spark, only_batch="b-1").columns == ["a b", "s", "tag"]
    assert rows(table.read(spark).select("s.`c-d`").distinct()) == [(2,)]
    # By name, not by position; other columns or types are refused.
    with pytest.raises(ValueError, match="has columns"):
        table.write(one.withColumnRenamed("a b", "z"), "b-2", {"tag": "p"})
    with pytest.raises(ValueError, match="has columns"):
        table.write(one.withColumn("a b", F.lit("1")), "b-2", {"tag": "p"})
    with pytest.raises(ValueError, match="partition value"):
        table.write(one, "../x", {"tag": "p"})
    with pytest.raises(ValueError, match="mode"):
        table.write(one, "b-2", {"tag": "p"}, mode="ignore")


def test_as_messages_types(spark):
    df = as_messages(spark.range(1), F.lit(1), F.col("id"), F.lit("{}"))
    assert df.schema.simpleString() == "struct<partition:int,offset:bigint,json:string,source:string>"


@pytest.mark.parametrize("local", [True, False])
def test_a_file_for_each_row(spark, tmp_path, monkeypatch, local):
    if not local:
        monkeypatch.setattr(files, "local_path", lambda *_: None)
    made = spark.createDataFrame([(1, "a\nb"), (1, "ä"), (2, "a\nb"), (None, None)], "digit int, value string")
    for part in (made, made.where("digit = 2")):
        one_file_each(part, str(tmp_path / "in"), end="\x00", by="digit")
    found = sorted((p.parent.name, p.read_bytes().decode()) for p in (tmp_path / "in").rglob("*.txt"))
    none = "digit=__HIVE_DEFAULT_PARTITION__"
    assert found == [("digit=1", "a\nb\x00"), ("digit=1", "ä\x00"), ("digit=2", "a\nb\x00"), ("digit=2", "a\nb\x00"), (none, "\x00")]
    # Spark's writer makes a file of checksums beside each file, and starts processes for both.
    assert bool(list((tmp_path / "in").rglob("*.crc"))) != local
    one_file_each(made.where("false"), str(tmp_path / "none"))
    assert list_files(spark, str(tmp_path / "none")).where("bytes > 0").isEmpty()


def test_many_small_files_are_scanned_by_few_tasks(spark, tmp_path):
    rows_ = spark.range(600).select(F.to_json(F.struct("id")).alias("value"))
    one_file_each(rows_.coalesce(2), str(tmp_path / "in"))
    most = dropdir.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    assert list_files(spark, str(tmp_path / "in")).rdd.getNumPartitions() <= most
    limits = {"suffix": ".txt", "stable_millis": 0}
    first = read_drop_batch(spark, str(tmp_path / "in"), max_files=200, **limits).persist()
    rest = read_drop_batch(spark, str(tmp_path / "in"), taken=first, **limits)
    found = [{r["json"] for r in f.select("json").collect()} for f in (first, rest)]
    assert [len(f) for f in found] == [200, 400] and not found[0] & found[1]
    assert set.union(*found) == {f'{{"id":{i}}}\n' for i in range(600)}
    first.unpersist()


def test_payload_files_are_scanned_by_few_tasks(spark, tmp_path):
    rows_ = spark.range(600).select(F.col("id").cast("string").alias("value"))
    one_file_each(rows_.coalesce(2), str(tmp_path / "in"), end="")
    payloads = read_payloads(spark, str(tmp_path / "in"))
    assert payloads.rdd.getNumPartitions() <= dropdir.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    assert {r["payload"] for r in payloads.collect()} == {str(i) for i in range(600)}
    stored = payloads.select("payload_ref")
    assert "content" not in stored._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]
    assert stored.distinct().count() == 600
