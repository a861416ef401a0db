import json
import random
from pathlib import Path

import numpy as np
import pytest

from fixtures import EVENTS, event, write_documents, rows
from shopmill.functions import events as E
from shopmill.operators import scale
from shopmill.sources import files
from shopmill.streaming import ingest as I


@pytest.fixture
def paths(tmp_path):
    return {n: str(tmp_path / n) for n in ("target", "mark", "checkpoint", "api")}


def _texts(spark, documents):
    texts = [(d if isinstance(d, str) else json.dumps(d),) for d in documents]
    return spark.createDataFrame(texts, "value string")


def _ids(spark, target):
    return [r[0] for r in rows(E.event_orders(I.stored_events(spark, target)).select("orderid"))]


def test_mark_defaults_and_grows(spark, paths):
    assert I.load_mark(spark, paths["mark"]) == I.DEFAULT_MARK
    I.save_mark(spark, paths["mark"], 7)
    I.save_mark(spark, paths["mark"], 5)
    assert I.load_mark(spark, paths["mark"]) == 7


def test_batch_pulls_in_id_order_and_resumes(spark, paths):
    raw = _texts(spark, EVENTS[::-1])
    first = I.ingest_batch(raw, paths["target"], paths["mark"], limit=3).first()
    assert (first["received"], first["uploaded"], first["previous_mark"]) == (4, 3, 2_000_000)
    assert first["new_mark"] == 2000003
    second = I.ingest_batch(raw, paths["target"], paths["mark"], limit=3).first()
    assert (second["uploaded"], second["skipped"], second["new_mark"]) == (1, 3, 2000004)
    third = I.ingest_batch(raw, paths["target"], paths["mark"]).first()
    assert (third["message"], third["uploaded"], third["new_mark"]) == ("No new orders", 0, 2000004)
    assert _ids(spark, paths["target"]) == [2000001, 2000002, 2000003, 2000004]


def test_repeated_run_without_a_saved_mark_adds_nothing(spark, paths, tmp_path):
    raw = _texts(spark, EVENTS)
    I.ingest_batch(raw, paths["target"], paths["mark"])
    again = I.ingest_batch(raw, paths["target"], str(tmp_path / "lost_mark")).first()
    assert again["uploaded"] == 0
    assert len(_ids(spark, paths["target"])) == 4


def test_bad_events_are_set_aside_once(spark, paths):
    raw = _texts(spark, [EVENTS[0], "{broken", '{"order":{"OrderID":"x"},"order_details":[]}'])
    assert I.ingest_batch(raw, paths["target"], paths["mark"]).first()["quarantined"] == 2
    assert I.ingest_batch(raw, paths["target"], paths["mark"]).first()["quarantined"] == 0
    assert spark.read.parquet(paths["target"] + "_quarantine").count() == 2
    assert _ids(spark, paths["target"]) == [2000001]


def test_strict_writes_nothing(spark, paths):
    raw = _texts(spark, [EVENTS[0], "{broken"])
    with pytest.raises(ValueError, match="1 broken"):
        I.ingest_batch(raw, paths["target"], paths["mark"], strict=True)
    assert _ids(spark, paths["target"]) == []
    assert I.load_mark(spark, paths["mark"]) == I.DEFAULT_MARK


def test_late_id_is_skipped_in_batch(spark, paths):
    I.ingest_batch(_texts(spark, EVENTS[2:]), paths["target"], paths["mark"])
    late = I.ingest_batch(_texts(spark, EVENTS[:1]), paths["target"], paths["mark"]).first()
    assert (late["skipped"], late["uploaded"]) == (1, 0)


def test_stream_takes_new_files_late_ids_and_no_duplicates(spark, paths, tmp_path):
    source = tmp_path / "landing"
    write_documents(source, [EVENTS[2], EVENTS[3], "{broken"])
    I.ingest_stream(spark, str(source), paths["target"], paths["checkpoint"]).awaitTermination()
    assert _ids(spark, paths["target"]) == [2000003, 2000004]
    write_documents(source, [EVENTS[0], EVENTS[2], "{broken"])
    I.ingest_stream(spark, str(source), paths["target"], paths["checkpoint"]).awaitTermination()
    assert _ids(spark, paths["target"]) == [2000001, 2000003, 2000004]
    assert spark.read.parquet(paths["target"] + "_quarantine").count() == 1


def test_event_headers_append_once(spark, paths, tmp_path):
    folder = write_documents(tmp_path / "in", [*EVENTS, event(2000001, [])])
    events = files.read_events(spark, folder)
    assert I.append_event_orders(events, paths["api"]) == 4
    assert I.append_event_orders(events, paths["api"]) == 0
    back = spark.read.parquet(paths["api"])
    assert rows(back.select("orderid", "year", "month"))[0] == (2000001, 2026, 9)


def _version(order_id, second, status):
    later = event(order_id, [(1, 1, 2.0, 0.0)])
    later["metadata"]["event_timestamp"] = f"2027-01-01T00:00:{second:02}+00:00"
    later["order"]["Status"] = status
    return later


def _status(spark, target):
    return dict(rows(E.event_orders(I.stored_events(spark, target)).select("orderid", "status")))


def test_limit_takes_whole_orders(spark, paths):
    """Two documents of one order and a limit of one order: both are stored."""
    raw = _texts(spark, [_version(5, 1, "Pending"), _version(5, 2, "Shipped"), _version(6, 1, "Pending")])
    I.save_mark(spark, paths["mark"], 0)
    first = I.ingest_batch(raw, paths["target"], paths["mark"], limit=1).first()
    assert (first["uploaded"], first["new_mark"]) == (1, 5)
    assert spark.read.parquet(paths["target"]).count() == 2
    I.ingest_batch(raw, paths["target"], paths["mark"], limit=1)
    assert spark.read.parquet(paths["target"]).count() == 3
    assert _status(spark, paths["target"]) == {5: "SHIPPED", 6: "PENDING"}


def test_latest_version_wins_in_and_across_batches(spark, paths, tmp_path):
    I.save_mark(spark, paths["mark"], 0)
    I.ingest_batch(_texts(spark, [_version(5, 9, "Shipped"), _version(5, 1, "Confirmed")]), paths["target"], paths["mark"])
    assert _status(spark, paths["target"]) == {5: "SHIPPED"}
    I.save_mark(spark, str(tmp_path / "again"), 0)
    newer = _texts(spark, [_version(5, 20, "Delivered"), _version(5, 3, "Pending"), _version(5, 9, "Shipped")])
    row = I.ingest_batch(newer, paths["target"], str(tmp_path / "again")).first()
    assert (row["uploaded"], row["replaced"]) == (0, 1)
    assert _status(spark, paths["target"]) == {5: "DELIVERED"}
    assert spark.read.parquet(paths["target"]).count() == 4  # each version once


def test_pull_prunes_folders_below_the_mark(spark, tmp_path):
    path = str(tmp_path / "landed")
    texts = [(json.dumps(event(i, [])), i // I.IDS_PER_FOLDER) for i in (5, 3_000_001)]
    spark.createDataFrame(texts, "value string, id_bucket long").write.partitionBy("id_bucket").text(path)
    raw = spark.read.schema("value string, id_bucket long").text(path)
    plan = I.above_mark(raw, 2_500_000)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(id_bucket" in plan and ">= 2)" in plan
    row = I.ingest_batch(raw, str(tmp_path / "t"), str(tmp_path / "m")).first()
    assert (row["received"], row["uploaded"], row["skipped"]) == (1, 1, 0)


def test_a_pull_leaves_no_intermediates(spark, paths, tmp_path, monkeypatch):
    root = tmp_path / "shared"
    monkeypatch.setattr(scale, "checkpoint_root", lambda spark: str(root))
    I.ingest_batch(_texts(spark, [*EVENTS, "{broken"]), paths["target"], paths["mark"])
    assert not list(root.rglob("*.parquet"))


def _files_of(target):
    return {str(f) for f in Path(target).rglob("*.parquet")}


def _at(order_id, second, status="Pending"):
    return _version(order_id, second, status)


def test_compaction_rewrites_touched_folders_only_and_spares_readers_the_rank(spark, paths, tmp_path):
    far = 3 * I.IDS_PER_FOLDER
    first = [_at(5, 1), _at(5, 2, "Shipped"), _at(far + 1, 1), _at(far + 1, 9, "Shipped"), _at(far + 2, 1)]
    I.save_mark(spark, paths["mark"], 0)
    I.ingest_batch(_texts(spark, first), paths["target"], paths["mark"])
    before = _status(spark, paths["target"])
    assert I.compact(spark, paths["target"]) == 2 and I.compact(spark, paths["target"]) == 0
    assert spark.read.parquet(paths["target"]).count() == 3
    plan = I.stored_events(spark, paths["target"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan
    assert _status(spark, paths["target"]) == before == {5: "SHIPPED", far + 1: "SHIPPED", far + 2: "PENDING"}

    old = _files_of(paths["target"])
    I.save_mark(spark, str(tmp_path / "again"), 0)
    I.ingest_batch(_texts(spark, [_at(5, 30, "Delivered"), _at(5, 1)]), paths["target"], str(tmp_path / "again"))
    plan = I.stored_events(spark, paths["target"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "id_bucket" in plan
    assert _status(spark, paths["target"]) == before | {5: "DELIVERED"}
    assert I.compact(spark, paths["target"]) == 1
    now = _files_of(paths["target"])
    assert {f for f in old if "id_bucket=3" in f} <= now and not {f for f in old if "id_bucket=0" in f} & now
    assert _status(spark, paths["target"]) == before | {5: "DELIVERED"}
    assert spark.read.parquet(paths["target"]).count() == 3


def test_compaction_that_died_before_its_log_is_repeated(spark, paths, monkeypatch):
    I.save_mark(spark, paths["mark"], 0)
    I.ingest_batch(_texts(spark, [_at(5, 1), _at(5, 2, "Shipped")]), paths["target"], paths["mark"])
    I.compact(spark, paths["target"])
    I.save_mark(spark, paths["mark"] + "2", 0)
    I.ingest_batch(_texts(spark, [_at(5, 3, "Delivered")]), paths["target"], paths["mark"] + "2")
    log = spark.read.parquet(paths["target"] + "_compacted").collect()
    I.compact(spark, paths["target"])
    # As if the last rows of the log had not been written: the folder holds one row where the log says one as well,
    # or counts as touched; either way readers see the latest version.
    spark.createDataFrame(log, I.COMPACTED).write.mode("overwrite").parquet(paths["target"] + "_compacted")
    assert _status(spark, paths["target"]) == {5: "DELIVERED"}
    I.compact(spark, paths["target"])
    assert _status(spark, paths["target"]) == {5: "DELIVERED"}


def test_compaction_of_nothing(spark, paths):
    assert I.compact(spark, paths["target"]) == 0
    assert I.stored_events(spark, paths["target"]).count() == 0


def test_a_pull_judges_each_text_once(spark, paths, monkeypatch):
    """The frame of texts is evaluated by one job: a source that counts its reads shows it."""
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    raw = _texts(spark, [*EVENTS, "{broken"]).mapInPandas(seen, "value string")
    I.ingest_batch(raw, paths["target"], paths["mark"], limit=2)
    assert reads.value == len(EVENTS) + 1


def test_keyed_stream_equals_the_batch_with_files_out_of_order_and_repeated(spark, paths, tmp_path):
    a, b, c = _at(5, 1, "Pending"), _at(5, 9, "Shipped"), _at(5, 4, "Confirmed")
    deliveries = [[b, _at(9, 1), "{broken", a], [c, b, _at(7, 1), "{broken"], [_at(5, 20, "Delivered"), _at(9, 1)]]
    source = tmp_path / "landing"
    for delivery in deliveries:
        write_documents(source, delivery)
        I.ingest_stream_keyed(spark, str(source), paths["target"], paths["checkpoint"]).awaitTermination()
    other = str(tmp_path / "batch")
    I.save_mark(spark, paths["mark"], 0)
    I.ingest_batch(_texts(spark, [d for ds in deliveries for d in ds]), other, paths["mark"])
    assert _status(spark, paths["target"]) == _status(spark, other) == {5: "DELIVERED", 7: "PENDING", 9: "PENDING"}
    assert rows(I.stored_events(spark, paths["target"])) == rows(I.stored_events(spark, other))
    assert spark.read.parquet(paths["target"] + "_quarantine").count() == 1
    log = [tuple(r)[1:] for r in spark.read.parquet(paths["target"] + "_log").orderBy("batch").collect()]
    # new, replaced, stale, repeated, broken, late, mark
    assert log == [(2, 1, 0, 0, 1, 0, 9), (1, 0, 1, 2, 0, 1, 9), (0, 1, 0, 1, 0, 0, 9)]


def test_keyed_stream_reads_no_store(spark, paths, tmp_path, monkeypatch):
    source = tmp_path / "landing"
    write_documents(source, [_at(5, 1)])
    I.ingest_stream_keyed(spark, str(source), paths["target"], paths["checkpoint"]).awaitTermination()
    asked = []
    monkeypatch.setattr(I, "read_or_empty", lambda s, path, schema, f=I.read_or_empty: asked.append(path) or f(s, path, schema))
    write_documents(source, [_at(5, 2, "Shipped")])
    I.ingest_stream_keyed(spark, str(source), paths["target"], paths["checkpoint"]).awaitTermination()
    assert paths["target"] not in asked
    assert _status(spark, paths["target"]) == {5: "SHIPPED"}


def test_a_keyed_stream_keeps_one_state_for_neighbouring_orders(spark, paths, tmp_path):
    """Python is called once for 300 orders and once for the broken texts, not once an order."""
    source = tmp_path / "lines"
    source.mkdir()
    texts = [json.dumps(_at(i, i % 50)) for i in range(1, 301)] + ["{broken"] * 3
    (source / "a.txt").write_text("\n".join(texts) + "\n")
    query = I.ingest_stream_keyed(spark, str(source), paths["target"], paths["checkpoint"], whole_files=False)
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 2
    assert I.stored_events(spark, paths["target"]).count() == 300
    log = spark.read.parquet(paths["target"] + "_log").first()
    assert (log["new"], log["repeated"], log["broken"], log["mark"]) == (300, 2, 1, 300)


def _told_one_by_one(last, documents):
    """The definition: an order's documents of a micro-batch by time, each against the last version taken."""
    verdicts = []
    for moment, digest in sorted(documents):
        if last is not None and digest == last[1]:
            verdicts.append("repeated")
        elif last is not None and last[0] != I.NO_MOMENT and (moment, digest) < last:
            verdicts.append("stale")
        else:
            verdicts.append("new" if last is None else "replaced")
            last = moment, digest
    return sorted(zip(sorted(documents), verdicts)), last


@pytest.mark.parametrize("seed", range(20))
def test_verdicts_of_a_group_are_those_of_its_orders_one_by_one(seed):
    r = random.Random(seed)
    held, known = (np.empty(0, "i8"), np.empty(0, "i8"), np.empty(0, "S64")), {}
    for _ in range(6):
        sent = [(r.randint(1, 9), m := r.choice([I.NO_MOMENT, 1, 2, 3, 4]), f"{m * 7 & 15:x}{r.randint(0, 2)}" * 32) for _ in range(r.randint(1, 40))]
        ids, moments = (np.array([d[i] for d in sent], "i8") for i in (0, 1))
        verdicts, held = I._orders_told(ids, moments, np.array([d[2] for d in sent], "S64"), held)
        for order in set(ids.tolist()):
            wanted, known[order] = _told_one_by_one(known.get(order), [d[1:] for d in sent if d[0] == order])
            assert sorted((d[1:], v) for d, v in zip(sent, verdicts) if d[0] == order) == wanted
        assert [(i, (m, d.decode())) for i, m, d in zip(*(h.tolist() for h in held))] == sorted(known.items())
