import json
import struct
import time

import pytest

from tabloom.config import EngineConfig
from tabloom.operators import cells as C
from tabloom.plans.ledger import Ledger
from tabloom.plans.pipeline import decision, process_object
from tabloom.plans.queries import csv_text, xlsx_bytes
from tabloom.sources.grid import GridDataSource, read_grid, read_large_csv, read_object
from tabloom.sources.messages import broker_stream, parse_messages, route
from tabloom.sources.parse import UnsupportedFormat, parse_csv, parse_file, parse_xlsx
from tabloom.streaming.listener import Listener

TABLE = [["id", "name", "amt"], [1, "ann", 2.5], [2, "bob", 3], [3, "cy", 4]]


def test_csv():
    assert parse_csv(b"a;b\n\n1;2\n  \n;N/A\n") == [["a", "b"], ["1", "2"], [None, None]]
    assert parse_csv(b"") == [] and parse_csv("﻿a,b\n1\n".encode()) == [["a", "b"], ["1", None]]
    assert parse_csv(b'a,b\n"x\ny",",,"\n') == [["a", "b"], ["x\ny", ",,"]]
    with pytest.raises(ValueError, match="fields"):
        parse_csv(b"a,b\n1,2,3\n")
    with pytest.raises(UnicodeDecodeError):
        parse_csv(b"\xff\xfe")


def test_xlsx():
    book = dict(parse_xlsx(xlsx_bytes({"One": TABLE, "empty": [], "B & C": [[None, "x"], ["n/a", 7.0]]})))
    assert book["One"][1] == ["1", "ann", "2.5"] and book["empty"] == [] and book["B & C"] == [[None, "x"], [None, "7"]]


def xls_bytes(sheets, pad=0, piece=8000):
    """A small workbook in the older format: shared strings (cut into continuations of `piece` bytes), numbers, a date style, formulas."""
    rec = lambda kind, body=b"": struct.pack("<HH", kind, len(body)) + body
    words = sorted({v for rows in sheets.values() for r in rows for v in r if isinstance(v, str)})
    sst, pieces = struct.pack("<II", len(words), len(words)), []
    for w in words:
        if len(sst) + 3 > piece:
            pieces.append(sst)
            sst = b""
        sst += struct.pack("<HB", len(w), 1)
        for ch in w:
            if len(sst) + 2 > piece:
                pieces.append(sst)
                sst = b"\x01"
            sst += ch.encode("utf-16-le")
    pieces.append(sst)
    shared = rec(0xFC, pieces[0]) + b"".join(rec(0x3C, p) for p in pieces[1:])
    styles = rec(0x41E, struct.pack("<HHB", 164, 10, 0) + b"yyyy-mm-dd") + rec(0xE0, struct.pack("<HH", 0, 0) + bytes(16)) + rec(0xE0, struct.pack("<HH", 0, 164) + bytes(16))
    bodies = []
    for rows in sheets.values():
        out = rec(0x809, struct.pack("<HH", 0x600, 0x10) + bytes(12))
        for r, row in enumerate(rows):
            for c, v in enumerate(row):
                at = struct.pack("<HHH", r, c, 0)
                if isinstance(v, bool):
                    out += rec(0x205, at + bytes([v, 0]))
                elif isinstance(v, str):
                    out += rec(0xFD, at + struct.pack("<I", words.index(v)))
                elif isinstance(v, int):
                    out += rec(0x27E, at + struct.pack("<i", v << 2 | 2))
                elif isinstance(v, float):
                    out += rec(0x203, at + struct.pack("<d", v))
                elif isinstance(v, tuple):  # a date, or a formula's text
                    out += rec(0x203, struct.pack("<HHHd", r, c, 1, v[1])) if v[0] == "date" else rec(0x06, at + b"\0\0\0\0\0\0\xff\xff" + bytes(8)) + rec(0x207, struct.pack("<HB", len(v[1]), 0) + v[1].encode())
        bodies.append(out + rec(0x0A))
    names = [rec(0x85, struct.pack("<IBBBB", 0, 0, 0, len(n), 0) + n.encode()) for n in sheets]
    head = rec(0x809, struct.pack("<HH", 0x600, 5) + bytes(12)) + styles
    begin = len(head) + sum(map(len, names)) + len(shared) + len(rec(0x0A))
    at, marks = begin, b""
    for n, body in zip(sheets, bodies, strict=True):
        marks += rec(0x85, struct.pack("<IBBBB", at, 0, 0, len(n), 0) + n.encode())
        at += len(body)
    stream = head + marks + shared + rec(0x0A) + b"".join(bodies) + bytes(pad)
    size, small = 512, len(stream) < 4096
    end, free = 0xFFFFFFFE, 0xFFFFFFFF
    chunks = -(-len(stream) // size)
    entry = lambda name, kind, first, n: (name.encode("utf-16-le") + b"\0\0").ljust(64, b"\0") + struct.pack("<HBB", 2 * len(name) + 2, kind, 1) + bytes(48) + struct.pack("<II", first, n) + bytes(4)
    # Sectors: allocation table, directory, (table of small sectors), the stream.
    first = 3 if small else 2
    fat = [0xFFFFFFFD, end, *([end] if small else []), *range(first + 1, first + chunks), end]
    fat += [free] * (128 - len(fat))
    root = entry("Root Entry", 5, first if small else end, len(stream) if small else 0)
    folder = root + entry("Workbook", 2, 0 if small else first, len(stream)) + bytes(256)
    parts = -(-len(stream) // 64)
    minis = ([*range(1, parts), end] + [free] * 128)[:128]
    header = bytes.fromhex("d0cf11e0a1b11ae1") + bytes(16) + struct.pack("<HHHHH", 0x3E, 3, 0xFFFE, 9, 6) + bytes(10) + struct.pack("<IIIIIIIII", 1, 1, 0, 4096, 2 if small else end, int(small), end, 0, 0)
    header += struct.pack("<108I", *[free] * 108)
    table = struct.pack("<128I", *minis) if small else b""
    return header + struct.pack("<128I", *fat) + folder + table + stream.ljust(chunks * size, b"\0")


@pytest.mark.parametrize("pad", [0, 5000])
def test_xls(pad):
    sheets = {"One": TABLE, "Two": [["é你", True, None, ("date", 45293.5)], [("text", "sum"), -7, 2.25, "N/A"]]}
    for piece in (8000, 20):
        book = dict(parse_file("a.xls", xls_bytes(sheets, pad, piece)))
        assert book["One"] == [["id", "name", "amt"], ["1", "ann", "2.5"], ["2", "bob", "3"], ["3", "cy", "4"]]
        assert book["Two"] == [["é你", "True", None, "2024-01-02 12:00:00"], ["sum", "-7", "2.25", None]]
    for bad in (b"", b"PK\x03\x04", bytes.fromhex("d0cf11e0a1b11ae1") + bytes(600)):
        with pytest.raises((ValueError, IndexError, ArithmeticError)):
            list(parse_file("a.xls", bad))


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "one.csv").write_text(csv_text(TABLE))
    two = [*TABLE, [None] * 3, ["k", "v"], ["x", 1], ["y", 2]]
    (tmp_path / "two.csv").write_text(csv_text(two))
    (tmp_path / "merged.csv").write_text(csv_text(TABLE) + "\n" + csv_text([["k", "v"], ["x", 1], ["y", 2]]))
    (tmp_path / "book.xlsx").write_bytes(xlsx_bytes({"S1": TABLE, "S2": [["nothing"]]}))
    (tmp_path / "note.txt").write_text("x")
    (tmp_path / "lonely.csv").write_text("a,b\n")
    return tmp_path


def test_readers(spark, folder):
    spark.dataSource.register(GridDataSource)
    rows = [tuple(r)[1:] for r in read_grid(spark, f"file://{folder}/one.csv").orderBy("row_idx").collect()]
    assert rows[0] == ("_default_", 0, ["id", "name", "amt"]) and rows[3] == ("_default_", 3, ["3", "cy", "4"])
    assert spark.read.format("grid").option("sheet", "S1").load(f"{folder}/book.xlsx").count() == 4
    assert sorted(map(tuple, read_large_csv(spark, f"file://{folder}/one.csv").select("row_idx", "cells").collect())) == [tuple(r[1:]) for r in rows]
    with pytest.raises(FileNotFoundError):
        read_object(spark, f"{folder}/gone.csv")
    with pytest.raises(UnsupportedFormat):
        read_object(spark, f"{folder}/note.txt")


def test_large_csv_is_numbered_over_splits(spark, tmp_path):
    lines = [f"{k},v{k}" for k in range(5000)]
    (tmp_path / "big.csv").write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000b")
    try:
        got = read_large_csv(spark, f"file://{tmp_path}/big.csv").select("row_idx", "cells").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == 5000 and all(r["cells"] == [str(r["row_idx"]), f"v{r['row_idx']}"] for r in got)


@pytest.mark.parametrize(
    "text",
    [
        "a;b;c\n1;n/a;x\n;;\n\n   \n2;null;\"q;\"\"r\"\"\"\n", "\ufeffid,name\n1,ann\n2\n", "k|v\n1|2\n", "x,y\n\"one\ntwo\",3\n4,\"5,6\"\n", "a b,c\n1,2\n3 4 5,6\n", "one\ntwo\n", "\n\n", "",
    ],
)
def test_large_csv_is_read_like_a_small_one(spark, tmp_path, text):
    (tmp_path / "t.csv").write_text(text)
    path = f"file://{tmp_path}/t.csv"
    rows = lambda df: sorted((r["sheet"], r["row_idx"], r["cells"]) for r in df.collect())
    assert rows(read_object(spark, path, large_csv=-1)) == rows(read_object(spark, path))


def test_large_csv_with_a_row_that_is_too_wide(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,2,3\n")
    with pytest.raises(Exception, match="more fields"):
        read_object(spark, f"file://{tmp_path}/t.csv", large_csv=-1).collect()


def run(spark, folder, name, dataset, **options):
    return process_object(spark, f"file://{folder}/{name}", dataset, EngineConfig(source_dir=str(folder), **options))


def test_objects(spark, folder):
    one = run(spark, folder, "one.csv", "t_objects")
    assert [(s.table, s.outcome, s.n_rows) for s in one] == [("one", "loaded", 3)]
    assert [tuple(r) for r in spark.table("t_objects.one").orderBy("id").collect()] == [(1, "ann", 2.5), (2, "bob", 3.0), (3, "cy", 4.0)]
    two = run(spark, folder, "two.csv", "t_objects", detect="distributed")
    assert [(s.table, s.n_rows) for s in two] == [("two__default__table_1", 3), ("two__default__table_2", 2)]
    assert [s.n_rows for s in run(spark, folder, "merged.csv", "t_objects")] == [6]
    assert [(s.table, s.n_rows) for s in run(spark, folder, "book.xlsx", "t_objects")] == [("book_S1", 3)]
    assert run(spark, folder, "lonely.csv", "t_objects") == []
    spark.sql("CREATE TABLE t_objects.other (z array<int>)")
    spark.read.csv(f"file://{folder}/one.csv", header=True).write.parquet(f"file://{folder}/p.parquet")
    assert [s.table for s in run(spark, folder, "p.parquet", "t_objects")] == ["p"]
    with pytest.raises(ValueError, match="dataset"):
        run(spark, folder, "one.csv", "my-ds")


def test_a_dataset_may_begin_with_a_digit(spark, folder):
    got = run(spark, folder, "one.csv", "123abc")
    assert [(s.outcome, s.n_rows, s.table_rows, s.warning) for s in got] == [("loaded", 3, 3, None)]
    assert run(spark, folder, "one.csv", "123abc")[0].table_rows == 6
    with pytest.raises(ValueError, match="dataset"):
        run(spark, folder, "one.csv", "abc\n")


def test_losses_are_reported(spark, folder):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_loss")
    spark.sql("CREATE TABLE IF NOT EXISTS t_loss.mixed (k BIGINT, v BIGINT) USING parquet")
    (folder / "mixed.csv").write_text("k,v\n" + "".join(f"{k},{'word' if k < 7 else k}\n" for k in range(30)))
    got = run(spark, folder, "mixed.csv", "t_loss")
    assert [(s.outcome, s.n_rows, s.warning) for s in got] == [("loaded", 30, "v: 7 of 30 values lost")]


def test_the_first_rows_are_suggested_from(spark, folder):
    (folder / "order.csv").write_text("id,name\n" + "".join(f"{k},n{k}\n" for k in (9, 3, 7, 1, 8, 2, 5)))
    seen = []

    def suggester(sample, columns):
        seen.append((sample, columns))
        return '[{"name": "id", "type": "STRING"}, {"name": "name", "type": "STRING"}]'

    config = EngineConfig(source_dir=str(folder), schema_strategy="suggest")
    assert process_object(spark, f"file://{folder}/order.csv", "t_order", config, suggester)[0].n_rows == 7
    assert [r["id"] for r in json.loads(seen[0][0])] == ["9", "3", "7", "1", "8"] and seen[0][1] == ["id", "name"]
    assert spark.table("t_order.order").columns == ["id", "name"]


def test_a_slow_suggester_is_given_up(spark, folder):
    config = EngineConfig(source_dir=str(folder), schema_strategy="suggest_or_sniff", suggest_timeout_s=1)
    begin = time.monotonic()
    got = process_object(spark, f"file://{folder}/one.csv", "t_slow", config, lambda sample, columns: time.sleep(120))
    assert got[0].outcome == "loaded" and time.monotonic() - begin < 60


def test_a_batch_that_is_run_again_loads_nothing_twice(spark, folder, monkeypatch):
    """The stream breaks off between two tables, and between a load and its row in the ledger; the batch is run again."""
    messages = spark.createDataFrame([("two.csv", "t_again", None)], "object_name string, target_dataset_id string, _corrupt_record string")
    log = Listener(spark, EngineConfig(source_dir=f"file://{folder}"), "t_again_log")

    class Crash(BaseException):
        pass

    def crash(*a, **b):
        raise Crash

    finish = Ledger.finish
    calls = []
    monkeypatch.setattr(Ledger, "finish", lambda self, *a: calls.append(a) or (crash() if len(calls) == 2 else finish(self, *a)))
    with pytest.raises(Crash):
        log.batch(messages, 0)
    log.batch(messages, 0)
    counts = [spark.table(f"t_again.two__default__table_{k}").count() for k in (1, 2)]
    assert counts == [3, 2] and [r["status"] for r in spark.table(log.outcomes).collect()] == ["ok"]


def test_a_load_leaves_no_job_group(spark, folder):
    run(spark, folder, "one.csv", "t_group")
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None


def test_one_table_fails(spark, folder):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_partial")
    spark.sql("CREATE TABLE IF NOT EXISTS t_partial.two__default__table_2 (z array<int>) USING parquet")
    got = run(spark, folder, "two.csv", "t_partial")
    assert [s.outcome for s in got] == ["loaded", "failed"] and decision(got) == ("partial", "ack")
    assert decision(got[1:]) == ("failed", "nack") and decision([]) == ("ok", "ack")


def test_routes(spark):
    lines = ['{"object_name": "a.csv", "target_dataset_id": "ds"}', "{bad", '{"object_name": "a.csv"}', '{"object_name": "a.csv", "target_dataset_id": "my-ds"}', "[]", None]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(lines)], "k int, value string")
    assert [r["outcome"] for r in route(parse_messages(df)).orderBy("k").collect()] == ["ok", "nack", "nack", "nack", "nack", "nack"]


def test_listener(spark, folder):
    inbox = folder / "inbox"
    inbox.mkdir()
    line = lambda name, ds="t_listen": f'{{"object_name": "{name}", "target_dataset_id": "{ds}"}}\n'
    (inbox / "1.json").write_text(line("one.csv") + line("gone.csv") + line("note.txt") + "{bad\n" + line("one.csv", "my-ds") + line("lonely.csv") + '{"object_name": "x"}\n')
    log = Listener(spark, EngineConfig(source_dir=f"file://{folder}"), "t_log")
    log.start(str(inbox), str(folder / "checkpoint"), once=True).awaitTermination()
    got = {(r["object_name"], r["target_dataset_id"]): (r["status"], r["decision"]) for r in spark.table(log.outcomes).collect()}
    assert got[("one.csv", "t_listen")] == ("ok", "ack") and got[("gone.csv", "t_listen")] == ("missing", "ack") and got[("note.txt", "t_listen")] == ("unsupported", "dead")
    assert got[("one.csv", "my-ds")] == got[(None, None)] == got[("x", None)] == ("invalid", "nack") and got[("lonely.csv", "t_listen")] == ("ok", "ack")
    (inbox / "2.json").write_text(line("one.csv"))
    log.start(str(inbox), str(folder / "checkpoint"), once=True).awaitTermination()
    assert spark.table("t_listen.one").count() == 3 and spark.table(log.outcomes).where("status = 'repeated'").count() == 1
    assert spark.table(log.dead).count() == 4 and log.retry().count() == 0


def test_listener_on_a_broker_stream(spark, folder):
    """Lines of text stand for a broker's values."""
    inbox = folder / "values"
    inbox.mkdir()
    (inbox / "1.txt").write_text('{"object_name": "one.csv", "target_dataset_id": "t_broker"}\n{bad\n')
    log = Listener(spark, EngineConfig(source_dir=f"file://{folder}"), "t_broker_log")
    log.start(broker_stream(spark, "text", path=str(inbox)), str(folder / "checkpoint2"), once=True).awaitTermination()
    assert sorted((r["object_name"] or "", r["status"], r["reason"]) for r in spark.table(log.outcomes).collect()) == [("", "invalid", "bad JSON"), ("one.csv", "ok", None)]
    assert spark.table("t_broker.one").count() == 3


def test_config():
    assert EngineConfig.from_env({"TABLOOM_SOURCE_DIR": "/d", "TABLOOM_SAMPLE_ROWS": "9", "TABLOOM_TRIM_ROWS": "true"}) == EngineConfig(source_dir="/d", sample_rows=9, trim_rows=True)
    with pytest.raises(ValueError, match="SOURCE_DIR"):
        EngineConfig.from_env({})


def test_grid_of_parquet(spark, sf_dir):
    rows = read_object(spark, f"{sf_dir}/nation.parquet", parquet_as_grid=True)
    assert rows.count() == 25 and C.to_cells(rows).count() == 75


def test_session(spark):
    from tabloom.plans.session import configure_log, session

    assert session(EngineConfig(log_level="WARNING")) is spark or session(EngineConfig()).sparkContext is spark.sparkContext
    assert len(configure_log("INFO").handlers) == 1
