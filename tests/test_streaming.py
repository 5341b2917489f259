import datetime as dt
import json
import random

from pyspark.sql import functions as F

from litsieve.operators.dedupe import clusters, dedupe_candidates
from litsieve.operators.normalize import normalize_records
from litsieve.schemas import RAW
from litsieve.streaming import runs
from litsieve.streaming.keyed import KeyedTable
from litsieve.streaming.resolution import current_clusters, resolve_batch


def drain(stream, tmp_path, name):
    query = (
        stream.writeStream.format("parquet").option("path", str(tmp_path / name))
        .option("checkpointLocation", str(tmp_path / f"{name}-state")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(str(tmp_path / name))


def test_duplicates_across_runs(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    record = {"seq": 1, "title": "a", "doi": "10.1/a", "published": "2026-03-01T00:00:00Z"}
    (folder / "day1.json").write_text(json.dumps(record))

    def run():
        raw = runs.read_landed(spark, str(folder), RAW, files_per_batch=1).withColumns(
            {"tags": F.array().cast("array<string>"), "authors": F.array().cast("array<string>")}
        )
        runs.start_dedupe(normalize_records(raw), str(tmp_path / "work")).awaitTermination()
        return runs.read_deduped(spark, str(tmp_path / "work"), "seq bigint, dedupe_key string")

    assert run().count() == 1
    # A copy weeks later is still a copy, and so is one in the next file.
    later = [dict(record, seq=2, published="2026-05-01T00:00:00Z"), dict(record, seq=3, doi="10.1/b"), dict(record, seq=4, published="")]
    (folder / "day2.json").write_text("\n".join(json.dumps(r) for r in later))
    (folder / "day3.json").write_text(json.dumps(dict(record, seq=5, doi="10.1/b")))
    # Both files are written within a tick, so either may come first; the smaller seq stands.
    assert {r.seq for r in run().collect()} == {1, 3}
    undated = spark.read.schema("seq bigint").parquet(str(tmp_path / "work" / "undated"))
    assert [r.seq for r in undated.collect()] == [4]


def chained(draw, n):
    """Records with urls and dois out of few, so that clusters join late and in chains."""
    pick = lambda name, k: f"{name}{draw.randrange(k)}" if draw.random() < 0.6 else ""
    return [
        (i, f"https://x.org/{u}" if (u := pick("u", n // 2)) else "", f"10.1/{d}" if (d := pick("d", n // 2)) else "", "j", f"t{draw.randrange(n)}")
        for i in range(n)
    ]


def test_clusters_in_any_order(spark, tmp_path):
    draw = random.Random(4)
    rows = chained(draw, 60)
    records = spark.createDataFrame(rows, "seq long, canonical_url string, doi string, journal string, title_norm string")
    keys = records.select("seq", dedupe_candidates().alias("candidates"))
    want = {(r.seq, r.cluster) for r in clusters(keys).collect()}
    assert len({c for _, c in want}) < 50
    for turn in range(2):
        draw.shuffle(rows)
        folder = str(tmp_path / f"{turn}")
        for number in range(4):
            batch = spark.createDataFrame(rows[number::4], records.schema)
            resolve_batch(batch, folder, number)
            if number == 2:  # a batch that is repeated after a failure
                resolve_batch(batch, folder, number)
        assert {(r.seq, r.cluster) for r in current_clusters(spark, folder).collect()} == want


def test_first_record_wins_in_any_order(spark, tmp_path):
    def run(order):
        folder = tmp_path / "-".join(map(str, order))
        (folder / "in").mkdir(parents=True)
        for seq in order:
            row = {"seq": seq, "title": "a", "doi": f"10.1/{seq % 2}", "published": "2026-03-01T00:00:00Z"}
            (folder / "in" / f"{seq}.json").write_text(json.dumps(row))
            raw = runs.read_landed(spark, str(folder / "in"), RAW).withColumns(
                {"tags": F.array().cast("array<string>"), "authors": F.array().cast("array<string>")}
            )
            runs.start_dedupe(normalize_records(raw), str(folder / "work")).awaitTermination()
        kept = runs.read_deduped(spark, str(folder / "work"), "seq bigint, dedupe_key string, title_en string")
        return sorted((r.seq, r.dedupe_key, r.title_en) for r in kept.collect())

    assert run([4, 1, 3, 2]) == run([1, 2, 3, 4]) == [(1, "doi:10.1/1", "a"), (2, "doi:10.1/0", "a")]


def test_state_is_folded(spark, tmp_path):
    draw = random.Random(6)
    for smallest in (True, False):
        folder = tmp_path / str(smallest)
        table = KeyedTable(spark, str(folder), "k", "k string, v long", smallest, fold_every=2)
        batches = [[(f"k{draw.randrange(12)}", 100 * n + i) for i in range(draw.randrange(1, 5))] if n != 3 else [] for n in range(10)]
        for n, batch in enumerate(batches):
            rows = spark.createDataFrame(batch, "k string, v long")
            for _ in range(2 if n in (4, 8) else 1):  # repeated after a failure, with the fold done
                before = [r for b in batches[:n] for r in b]
                found = table.find(spark.createDataFrame([(f"k{i}",) for i in range(0, 12, 2)], "k string"), n)
                got = sorted((r.k, r.v) for r in found.collect())
                even = [r for r in before if int(r[0][1:]) % 2 == 0]
                if smallest:  # a fold keeps the smallest value only
                    least = {k: min(v for x, v in even if x == k) for k, _ in even}
                    assert {k: min(v for x, v in got if x == k) for k, _ in got} == least
                else:
                    assert got == sorted(even)
                table.put(rows, n)
        assert table.rows().select("k").distinct().count() == len({k for b in batches for k, _ in b})
        names = {p.name for p in folder.iterdir()}
        # Eight batches are one folder; those it replaced go with the next fold.
        assert {"batch=0-8", "batch=8", "batch=9"} <= names and not names & {"batch=0", "batch=1", "batch=2", "batch=0-2"}
        # A span without its marker is a write that was lost: what it was to replace is read.
        (folder / "batch=8-10").mkdir()
        assert [f[2] for f in table._cover()] == ["0-8", "8", "9"]


def test_late_rows_are_counted(spark, tmp_path):
    folder = str(tmp_path)
    day = lambda d, h: dt.datetime(2026, 3, d, h)
    for rows in ([(day(1, 18), "a"), (day(9, 12), "a")], [(day(1, 19), "a"), (day(8, 17), "b"), (None, "b")]):
        spark.createDataFrame(rows, "ts timestamp, kind string").write.mode("append").parquet(f"{folder}/in")
        events = spark.readStream.schema("ts timestamp, kind string").parquet(f"{folder}/in")
        runs.start_window_counts(events, folder, "ts", ["kind"], "12 hours").awaitTermination()
    got = {(r.window_end, r.kind): (r.n, r.n_late) for r in runs.read_window_counts(spark, folder, "kind string").collect()}
    # The row of the first evening came after both of its digests, the others in time.
    assert got[day(2, 0), "a"] == (1, 1) and got[day(3, 0), "a"] == (1, 1)
    assert got[day(9, 0), "b"] == (0, 1) and got[day(10, 0), "b"] == (1, 0) and got[None, "b"] == (1, 0)
    kept = spark.read.schema("ts timestamp, window_end timestamp").parquet(f"{folder}/late").collect()
    assert sorted((r.ts, r.window_end) for r in kept) == [(day(1, 19), day(2, 0)), (day(1, 19), day(3, 0)), (day(8, 17), day(9, 0))]


def test_window_counts_drop_late_rows(spark, tmp_path):
    folder = str(tmp_path / "events")
    rows = [(dt.datetime(2026, 3, 1, 18), "a"), (dt.datetime(2026, 3, 20), "a")]
    spark.createDataFrame(rows, "ts timestamp, kind string").coalesce(1).write.parquet(folder)

    def run():
        events = spark.readStream.schema("ts timestamp, kind string").parquet(folder)
        return drain(runs.window_counts(events, "ts", ["kind"]), tmp_path, "counts")

    first = {(r.window_start, r.n) for r in run().collect()}
    assert {s.day for s, n in first} >= {28, 1} and all(n == 1 for _, n in first)
    spark.createDataFrame([(dt.datetime(2026, 3, 1, 19), "a")], "ts timestamp, kind string").write.mode("append").parquet(folder)
    assert {(r.window_start, r.n) for r in run().collect()} == first


def test_record_stream_reads_a_file_or_a_folder(spark, tmp_path):
    from litsieve.plans.queries import stream_digest

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    assert stream_digest(spark, str(tmp_path)).count() == docs.count() == stream_digest(spark, "/root/testdata/sf0.001").count()


def test_landed_batches_have_a_file_per_core(spark, tmp_path):
    from litsieve.plans.queries import _landed

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    splits = spark.read.parquet(str(tmp_path / "documents.parquet")).rdd.getNumPartitions()
    seen = []
    stream = _landed(spark, str(tmp_path), str(tmp_path), 3)
    runs.start_batches(stream, lambda batch, n: seen.append(batch.count()), str(tmp_path / "state")).awaitTermination()
    assert splits > 1 and len(list((tmp_path / "in").glob("*.parquet"))) == 3 * splits
    assert len(seen) == 3 and sum(seen) == docs.count()
