import json
import os

import pytest
from pyspark.sql import functions as F
from records import posting

from boardweave.operators.latest import latest_wins, version_history
from boardweave.operators.typed import typed_postings
from boardweave.plans.facade import bronze
from boardweave.plans.session import STATE_STORE
from boardweave.sources import landing as G
from boardweave.streaming import bronze as SB
from boardweave.streaming import history as SH
from boardweave.streaming import silver as SS


class Area:
    def __init__(self, root):
        self.landing, self.paths = str(root / "landing"), [str(root / n) for n in ("bronze", "checkpoint", "schema")]

    def put(self, name, *rows):
        path = os.path.join(self.landing, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8") as f:
            f.writelines((r if isinstance(r, str) else json.dumps(r, ensure_ascii=False)) + "\n" for r in rows)

    def ingest(self, spark, **options):
        return SB.ingest(spark, self.landing, *self.paths, **options)

    def table(self, spark):
        return spark.read.parquet(self.paths[0])


@pytest.fixture
def area(tmp_path):
    return Area(tmp_path)


def test_each_file_once(spark, area):
    area.put("b1/one.ndjson", posting(Id=1), posting(Id=2))
    area.put("b1/ignored.csv", "not,json")
    assert area.ingest(spark) == 2
    assert area.ingest(spark) == 0
    area.put("b2/two.ndjson", posting(Id=3))
    area.put("b1/one.ndjson", posting(Id=1), posting(Id=2), posting(Id=9))  # a known path is not read again
    assert area.ingest(spark) == 1
    rows = area.table(spark).collect()
    assert sorted(r["Id"] for r in rows) == ["1", "2", "3"]
    assert all(r["_source_file"].endswith(".ndjson") and r["_ingested_at"] and r["_source_file_modified"] for r in rows)


def test_strings_only_and_rescue(spark, area):
    area.put("b/x.ndjson",
             '{"Id": 1, "SalaryMin": 1.5, "SalaryMax": 12345678901234567.89, "IsRemote": true, "Tags": ["a", "b"], "Title": "line\u2028sep"}', "",
             '{"Id": 2, "City": {"name": "Kyiv"}, "Tags": "solo"}', '{"Id": 3, broken', '{"Id": 4, "Extra": [1, 2]}')
    area.ingest(spark, evolve=False)
    rows = {r["Id"]: r for r in area.table(spark).collect()}
    assert rows["1"]["SalaryMin"] == "1.5" and rows["1"]["SalaryMax"] == "12345678901234567.89"
    assert rows["1"]["IsRemote"] == "true" and rows["1"]["Tags"] == ["a", "b"]
    assert rows["1"]["Title"] == "line\u2028sep" and rows["1"]["_rescued_data"] is None
    assert json.loads(rows["2"]["City"]) == {"name": "Kyiv"} and rows["2"]["Tags"] is None
    assert json.loads(rows["2"]["_rescued_data"]) == {"Tags": "solo"}
    assert rows[None]["_rescued_data"] == '{"Id": 3, broken'
    assert json.loads(rows["4"]["_rescued_data"]) == {"Extra": [1, 2]}


def test_new_field_stops_once(spark, area):
    area.put("b/a.ndjson", posting(Id=1))
    assert area.ingest(spark) == 1
    area.put("b/b.ndjson", posting(Id=2, Shiny="new"))
    with pytest.raises(SB.UnseenFields) as stop:
        area.ingest(spark)
    assert stop.value.fields == ["Shiny"] and area.table(spark).count() == 1
    assert area.ingest(spark) == 1
    rows = {r["Id"]: r["Shiny"] for r in spark.read.option("mergeSchema", "true").parquet(area.paths[0]).collect()}
    assert rows == {"1": None, "2": "new"}
    assert area.ingest(spark) == 0


def test_reset_is_all_or_nothing(spark, area):
    area.put("b/a.ndjson", posting(Id=1))
    area.ingest(spark)
    assert G.reset_bronze(spark, *area.paths) is False and area.ingest(spark) == 0
    assert G.reset_bronze(spark, *area.paths, confirm=True) is True
    assert not any(os.path.exists(p) for p in area.paths) and area.ingest(spark) == 1


def test_landing_skips_what_is_there(spark, area):
    records = bronze(spark, "/root/testdata/sf0.001")
    assert G.land(records, area.landing, "x", ["board_0", "board_1"]) == ["board_0", "board_1"]
    assert G.land(records, area.landing, "x", ["board_0", "board_1", "board_2"]) == ["board_2"]
    landed = G.read_landing(spark, area.landing, glob="*.txt")
    assert landed.count() == records.filter("board IN ('board_0', 'board_1', 'board_2')").count()
    plain = G.read_json_strings(spark, f"{area.landing}/batch=x")
    assert plain.count() == landed.count() and dict(plain.dtypes)["Tags"] == "array<string>"
    assert typed_postings(plain).count() == landed.count()


def test_stream_equals_batch(spark, tmp_path):
    rows = bronze(spark, "/root/testdata/sf0.001")
    rows.write.parquet(str(tmp_path / "bronze"))
    counts = SS.stream_typed(SS.table_stream(spark, str(tmp_path / "bronze")), str(tmp_path / "typed"), str(tmp_path / "cp"))
    streamed, batch = spark.read.parquet(str(tmp_path / "typed")), typed_postings(rows)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    assert counts["rows"] == counts["source_identity_present"] == batch.count()


def test_fail_rule_leaves_no_rows(spark, bronze_of, tmp_path):
    bronze_of(posting(), posting(Id=None)).write.parquet(str(tmp_path / "bronze"))
    with pytest.raises(Exception, match="source_identity_present"):
        SS.stream_typed(SS.table_stream(spark, str(tmp_path / "bronze")), str(tmp_path / "typed"), str(tmp_path / "cp"))
    try:
        assert spark.read.parquet(str(tmp_path / "typed")).count() == 0
    except Exception as empty:
        assert "Unable to infer schema" in str(empty)


@pytest.mark.parametrize("stateful", [False, True])
def test_late_version_does_not_win(spark, bronze_of, tmp_path, stateful):
    src, log, cp = (str(tmp_path / n) for n in ("in", "log", "cp"))
    run, read = ((SS.stateful_latest, SS.read_touched) if stateful else (SS.upsert_log, SS.read_current))
    versions = [("2026-08-02", "new"), ("2026-08-01", "late"), ("2026-08-03", "newest"), ("2026-07-01", "older")]
    for when, title in versions:
        typed = typed_postings(bronze_of(posting(exported_at=when, Title=title), posting(Id=title)))
        typed.write.mode("append").parquet(src)
        run(SS.table_stream(spark, src), log, cp)
    want = latest_wins(spark.read.parquet(src))
    got = read(spark, log).select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.filter("source_id = 1").first()["title"] == "newest"


def test_state_in_memory_is_refused(spark, bronze_of, tmp_path):
    src, name = str(tmp_path / "in"), STATE_STORE[0]
    typed_postings(bronze_of(posting())).write.parquet(src)
    spark.conf.set(name, STATE_STORE[1].replace("RocksDB", "HDFSBacked"))
    try:
        with pytest.raises(ValueError, match="RocksDB"):
            SS.stateful_latest(SS.table_stream(spark, src), str(tmp_path / "log"), str(tmp_path / "cp"))
    finally:
        spark.conf.set(*STATE_STORE)


def test_full_refresh(spark, bronze_of, tmp_path):
    src, log = str(tmp_path / "in"), str(tmp_path / "log")
    typed_postings(bronze_of(posting(), posting(Id="2"))).write.parquet(src)
    SS.upsert_log(SS.table_stream(spark, src), log, str(tmp_path / "cp1"))
    SS.upsert_log(SS.table_stream(spark, src), str(tmp_path / "log2"), str(tmp_path / "cp2"))
    assert SS.read_current(spark, str(tmp_path / "log2")).exceptAll(SS.read_current(spark, log)).count() == 0


def test_compaction_leaves_readers_the_same_rows(spark, bronze_of, tmp_path):
    src, log = str(tmp_path / "in"), str(tmp_path / "log")
    later = [posting(Title="new", exported_at="2026-09-01T00:00:00"), posting(Title="late", exported_at="2026-07-01T00:00:00")]
    for n, rows in enumerate([[posting(), posting(Id="2")], later, [posting(Id="3")]]):
        typed_postings(bronze_of(*rows)).coalesce(1).write.mode("append").parquet(src)
        SS.upsert_log(SS.table_stream(spark, src), log, str(tmp_path / "cp"))
        assert SS.compact_log(spark, log, every=2) == (n == 1)
        got, want = SS.read_current(spark, log), latest_wins(spark.read.parquet(src))
        assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == want.count()
    assert SS.compacted_through(spark, log) == 1


ODD_LINES = ['{"Id":1.50,"Title":"a: 2.50, b"}', '{"Id":1e3}', '{"Id":123456789012345678901234567890123456789012,"x":[1.0,{"y":-0.10}]}',
             '{"Id":"5","Id":"6"}', '{"Id":', '{"Id":01}', '{"Title":"one line","Tags":[1.0,"two",null]}', '{"Id":"\\"7\\" 8.0,"}']


def test_bronze_keeps_the_text_of_numbers(spark, tmp_path):
    fields = {"Id": "string", "Title": "string", "Tags": "array<string>"}
    lines = spark.createDataFrame([(x,) for x in ODD_LINES], "value string")
    rows = [tuple(r) for r in G.parse_lines(lines, fields).collect()]
    assert rows == [
        ("1.50", "a: 2.50, b", None, None), ("1e3", None, None, None),
        ("123456789012345678901234567890123456789012", None, None, '{"x":[1.0,{"y":-0.10}]}'),
        ("6", None, None, '{"Id":"5","Id":"6"}'), (None, None, None, '{"Id":'), (None, None, None, '{"Id":01}'),
        (None, "one line", ["1.0", "two", None], None), ('"7" 8.0,', None, None, None)]
    lines.limit(3).coalesce(1).write.text(str(tmp_path / "plain"))
    assert [r.Id for r in G.read_json_strings(spark, str(tmp_path / "plain"), fields).collect()] == [r[0] for r in rows[:3]]


NESTED = ['{"Id":{"a":1.0,"b":[2]},"Tags":[{"k":1},[2]]}', '{"Id":[1, {"b" : 2,"a":1e3, "s":"]}\\""}], "Title" : "\ufdd0x", "Tags":["\ufdd01", 2.50, null ]}',
          '{"Title":"' + "m" * 1_000_000 + '","Tags":[ ]}', '{"Id":true,"Title":null,"Tags":null}', '{"Ti\\u0074le":"\\u00e9\\/","Id":-0.10}', '{ }',
          '{"Title":[' + ",".join('{"k":%d.0,"s":"v\\n"}' % i for i in range(20_000)) + "]}", '{"Id":' + "[" * 50 + "1" + "]" * 50 + "}"]


def test_nested_values_keep_their_text(spark, tmp_path):
    """The same text as a scan of the file gives, for every value that is no plain string too."""
    fields = {"Id": "string", "Title": "string", "Tags": "array<string>"}
    spark.createDataFrame([(x,) for x in NESTED], "value string").coalesce(1).write.text(str(tmp_path / "plain"))
    parsed = [tuple(r) for r in G.parse_lines(spark.read.text(str(tmp_path / "plain")), fields).collect()]
    assert [r[:3] for r in parsed] == [tuple(r) for r in G.read_json_strings(spark, str(tmp_path / "plain"), fields).collect()]
    assert parsed[0][0] == '{"a":1.0,"b":[2]}' and parsed[0][2] == ['{"k":1}', "[2]"] and parsed[1][1:3] == ("\ufdd0x", ["\ufdd01", "2.50", None])
    assert all(r[3] is None for r in parsed)


def test_rescued_values_keep_their_text(spark):
    lines = ['{"Z":{"z":1.50, "a":"\ufdd0q\\"\u00e9"},"Id":1,"Tags":"solo","A\\"b":[1.0]}', '{"Tags":{"x":1}}', '{"Id":' + "[" * 51 + "]" * 51 + "}", '{"X":null}']
    rows = [tuple(r) for r in G.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"), {"Id": "string", "Tags": "array<string>"}).collect()]
    assert rows == [("1", None, '{"A\\"b":[1.0],"Tags":"solo","Z":{"z":1.50, "a":"\ufdd0q\\"\u00e9"}}'), (None, None, '{"Tags":{"x":1}}'), (None, None, lines[2]), (None, None, '{"X":null}')]


def test_counts_survive_many_batches(spark, area):
    for n in range(105):
        area.put(f"{n}.ndjson", {"Id": "1"}, {"Id": "2"})
    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(area.landing).coalesce(1)
    assert SB.rows_ingested(SB.drain(lines, *area.paths[:2])) == 210


def test_a_feed_left_half_written_lands_again(spark, area):
    records = bronze(spark, "/root/testdata/sf0.001")
    G.land(records, area.landing, "x", ["board_0"])
    whole = G.read_landing(spark, area.landing, glob="*.txt").count()
    G.files.remove(spark, f"{area.landing}/batch=x/_landed/board_0")
    assert G.land(records, area.landing, "x", ["board_0"]) == ["board_0"]
    assert G.read_landing(spark, area.landing, glob="*.txt").count() == whole


def test_counts_are_those_of_the_table_after_a_crash(spark, area, monkeypatch):
    """The driver dies after the sink's commit and before it has looked at any progress."""
    area.put("a.ndjson", posting(Id=1), posting(Id=2))
    with monkeypatch.context() as broken:
        broken.setattr(SB, "finished", lambda query: (query.awaitTermination(), 1 / 0))
        with pytest.raises(ZeroDivisionError):
            area.ingest(spark)
    assert area.table(spark).count() == 2
    assert area.ingest(spark) == 0
    area.put("b.ndjson", posting(Id=3))
    assert area.ingest(spark) == 1
    batches = SB.ingested_batches(spark, area.paths[0]).collect()
    assert sorted(r["rows"] for r in batches) == [1, 2] and area.table(spark).count() == 3


def test_a_late_old_file_stops_once_and_only_pending_files_are_read(spark, area, monkeypatch):
    area.put("b/a.ndjson", posting(Id=1))
    assert area.ingest(spark) == 1
    area.put("b/late.ndjson", posting(Id=2, Shiny="new"), posting(Id=3, Other=1))
    os.utime(f"{area.landing}/b/late.ndjson", (1, 1))
    asked = []
    find = G.unseen_fields
    monkeypatch.setattr(G, "unseen_fields", lambda s, paths, known: asked.append(paths) or find(s, paths, known))
    with pytest.raises(SB.UnseenFields) as stop:
        area.ingest(spark)
    assert stop.value.fields == ["Other", "Shiny"]
    assert [[p.rsplit("/", 1)[1] for p in paths] for paths in asked] == [["late.ndjson"]]
    assert area.ingest(spark) == 2 and area.ingest(spark) == 0


def test_history_of_batches_in_any_order(spark, bronze_of, tmp_path):
    days = [posting(Status=s, exported_at=f"2026-08-{n:02}T00:00:00") for n, s in enumerate("Active Closed Active Active Active Closed Active".split(), 1)]
    other = [posting(Id="2", Status=s, exported_at=f"2026-08-01T00:{n:02}:00") for n, s in enumerate("Closed Closed Active Active Active".split(), 1)]
    typed = typed_postings(bronze_of(*days, *other))
    want = version_history(typed)
    for k, order in enumerate([(6, 2, 0, 4, 1, 3, 5), (3, 5, 1, 6, 0, 2, 4)]):
        src, log = str(tmp_path / f"in{k}"), str(tmp_path / f"log{k}")
        for n, i in enumerate(order):
            typed_postings(bronze_of(days[i], days[i], *other[i : i + 1])).coalesce(1).write.mode("append").parquet(src)
            if n in (2, 6):  # several batches in one drain, and a drain after others
                SH.history_log(SS.table_stream(spark, src, {"maxFilesPerTrigger": "1"}), log, str(tmp_path / f"cp{k}"))
        got = SH.read_history(spark, log).select(*want.columns)
        assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_history_batch_that_comes_twice(spark, bronze_of, tmp_path):
    """A batch whose commit was lost is written again, into its own folder."""
    src, log, cp = (str(tmp_path / x) for x in ("in", "log", "cp"))
    typed = typed_postings(bronze_of(posting(Status="Active"), posting(Status="Closed", exported_at="2026-09-01T00:00:00")))
    typed.coalesce(1).write.parquet(src)
    SH.history_log(SS.table_stream(spark, src), log, cp)
    for name in ("0", ".0.crc"):
        os.remove(f"{cp}/commits/{name}")
    SH.history_log(SS.table_stream(spark, src), log, cp)
    want = version_history(typed)
    assert SH.read_history(spark, log).select(*want.columns).exceptAll(want).count() == 0 and SH.read_history(spark, log).count() == want.count()


def test_plain_lines_are_scanned_and_all_others_keep_their_text(spark):
    """A scan reads only what it gives unchanged; every line has the columns and the rest that its text gives."""
    fields = {"a": "string", "b": "string", "t": "array<string>"}
    plain = ['{"a":"x","b":null,"t":["p","q"]}', ' { "a" : "q\\"\\u00e9\\n" , "b" : -12 } ', '{"t":[],"a":true}', '{"t":null}\r']
    others = ['{"a":1.50}', '{"a":1e3,"t":[1,"x"]}', '{"a":[1, 2]}', '{"a":"x","a":"y"}', '{"t":"x"}', '{"b":-0}', '{"c":"new"}',
              '{"a":"x"} {}', '{"a":"x",}', "no json", "{}", '{"a":{"z": 1}}', '{"a":"x" "b":"y"}', '{"A":"x"}', '{"a":01}', '{"a":"\\q"}']
    lines = spark.createDataFrame([(x,) for x in plain + others], "value string")
    told = {r["value"]: r["p"] for r in lines.select("value", G._is_plain(fields).alias("p")).collect()}
    assert [x for x in plain if not told[x]] == [] and [x for x in others if told[x]] == []
    got = {r["v"]: tuple(r)[:-1] for r in G.parse_lines(lines.withColumn("v", F.col("value")), fields).collect()}
    assert got[plain[0]] == ("x", None, ["p", "q"], None) and got[plain[1]] == ('q"\u00e9\n', "-12", None, None)
    assert got[plain[2]] == ("true", None, [], None) and got[plain[3]] == (None, None, None, None)
    assert got['{"a":1.50}'] == ("1.50", None, None, None) and got['{"b":-0}'][1] == "-0"
    assert got['{"a":"x","a":"y"}'] == ("y", None, None, '{"a":"x","a":"y"}') and got['{"c":"new"}'][3] == '{"c":"new"}'
    assert G.parse_lines(lines, fields, True).columns == [*fields, "_rescued_data"]
    apart = G.parse_lines(lines, {"a": "string", "A": "string"})  # one schema cannot hold these
    assert sorted(filter(None, (r[1] for r in apart.collect()))) == ["x"]


def test_the_one_file_of_a_batch_is_shared_and_orders_are_dealt_out(spark, tmp_path):
    from boardweave.plans import facade
    from boardweave.plans.queries import ROW_GROUP
    rows = spark.range(40_000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("a"), F.sha2(F.col("id").cast("string"), 384).alias("b"))
    rows.coalesce(1).write.option("parquet.block.size", ROW_GROUP).parquet(f"{tmp_path}/in")
    parts = SS.table_stream(spark, f"{tmp_path}/in", {"maxFilesPerTrigger": "1"})
    written = []
    parts.writeStream.foreachBatch(lambda batch, _: written.append(
        batch.groupBy(F.spark_partition_id()).count().count())).option("checkpointLocation", f"{tmp_path}/c").trigger(
        availableNow=True).start().awaitTermination()
    assert written and written[0] > 1
    orders = spark.range(400_000).select(*[F.xxhash64("id", F.lit(k)).alias(name) for k, name in enumerate(("o_orderkey", "o_custkey", "o_totalprice"))])
    dealt = facade.evenly(orders.coalesce(1)).groupBy(F.spark_partition_id()).agg(*[F.max(c) for c in orders.columns])
    assert len(dealt.collect()) > 1


def test_versions_of_a_bucket_lie_in_one_file(spark, tmp_path):
    rows = spark.range(2000).selectExpr("id % 500 AS k", "timestamp'2026-01-01' + make_interval(0, 0, 0, 0, 0, 0, id) AS ts", "'x' AS v")
    rows.repartition(8).write.parquet(f"{tmp_path}/in")
    SH.history_log(SS.table_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/log", f"{tmp_path}/c", ("k",), ("ts",), ())
    folders = list((tmp_path / "log" / "versions" / "batch=0").glob("bucket=*"))
    assert len(folders) > 32 and all(len(list(f.glob("*.parquet"))) == 1 for f in folders)


def test_one_batch_is_not_ranked_again(spark, bronze_of, tmp_path):
    rows = bronze_of(*[{"board": "b", "Id": str(i % 3), "exported_at": f"2026-08-0{1 + i}T00:00:00"} for i in range(6)])
    rows.write.parquet(f"{tmp_path}/in")
    SS.stream_typed(SS.table_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/typed", f"{tmp_path}/c1")
    SS.upsert_log(SS.table_stream(spark, f"{tmp_path}/typed"), f"{tmp_path}/log", f"{tmp_path}/c2")
    current = SS.read_current(spark, f"{tmp_path}/log")
    assert "Window" not in current._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["source_id"], r["exported_at"].day) for r in current.collect()) == [(0, 4), (1, 5), (2, 6)]
