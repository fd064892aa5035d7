"""Files cut into records in blocks of any size, against the plain parsers."""

import csv
import io
import json
import random

import pytest

from valuemark.config import Settings
from valuemark.sources import blocks as B
from valuemark.sources import prices as P


@pytest.fixture
def small_blocks(spark, monkeypatch):
    """Text files are read in blocks of a few bytes, what is written between the steps is not."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    size = []

    def conf(value):
        for k in before:
            spark.conf.set(k, str(value) if value else before[k])

    def read(*args, was=B._read):
        conf(size[0])
        return was(*args)

    def materialize(*args, was=B.materialize):
        done = was(*args)
        conf(None)
        return done

    monkeypatch.setattr(B, "_read", read)
    monkeypatch.setattr(B, "materialize", materialize)
    yield size.append
    conf(None)


def quoted(cell, rng):
    return f'"{cell.replace(chr(34), chr(34) * 2)}"' if rng.random() < 0.5 or any(c in cell for c in ',"\n\r') else cell


def made_csv(rng, rows):
    pieces = ["a", "bc", ",", '"', "\n", " ", "é", "470", '""', "x,y", '",', '\n"']
    return "".join(",".join(quoted("".join(rng.choice(pieces) for _ in range(rng.randrange(5))), rng) for _ in range(3)) + "\n" for _ in range(rows))


@pytest.mark.parametrize("size", [11, 90, 1 << 20])
def test_csv_records_of_any_block_size(spark, tmp_path, small_blocks, size):
    rng = random.Random(size)
    small_blocks(size)
    want, files = [], {}
    for k in range(3):
        text = made_csv(rng, 40 if size > 11 else 6) + ("5\" pipe,stray \"quotes\",end\n" if k else "")
        path = tmp_path / f"file {k}.csv"
        path.write_text(text, newline="")
        files[str(path)] = None
        want += [(str(path), *r) for r in csv.reader(io.StringIO(text, newline="")) if r]
    rows, notes = B.csv_records(spark, files)
    assert sorted((r.file, *r.cells) for r in rows.collect()) == sorted(want) and not notes
    some, _ = B.csv_records(spark, files, "470")
    assert sorted((r.file, *r.cells) for r in some.collect()) == sorted(w for w in want if any("470" in c for c in w[1:]))


def test_lines_end_inside_or_outside_as_the_csv_module_has_it():
    rng = random.Random(4)
    for _ in range(4000):
        line = "".join(rng.choice('a,"" ') for _ in range(rng.randrange(12)))
        for inside in (False, True):
            rows = list(csv.reader([('"' if inside else "") + line + "\n", "next\n"]))
            assert B.inside_after(line, inside) == (len(rows) == 1), (line, inside)


def made_json(rng, items):
    word = lambda: "".join(rng.choice(['a', '}', '{', '\\', '"', '[', 'standard_charge_information', 'é', '\n', ' ']) for _ in range(rng.randrange(6)))
    found = [{"description": word(), "x": {"y": [word(), {"z": word()}]}, "n": k} for k in range(items)]
    more = {word() + "k": {"standard_charge_information": [{"no": 1}]}, "notes": [{"description": "not an item", "t": word()}]}
    whole = {"hospital_name": "standard_charge_information", **more, "standard_charge_information": found, "tail": [{"t": word()}]}
    return json.dumps(whole, indent=rng.choice([None, 2]), ensure_ascii=False), found


@pytest.mark.parametrize("size", [9, 100, 1 << 20])
def test_json_items_of_any_block_size(spark, tmp_path, small_blocks, size):
    rng = random.Random(size)
    small_blocks(size)
    want, files = [], []
    for k in range(3):
        text, found = made_json(rng, 40 if size > 9 else 3)
        path = tmp_path / f"f{k}.json"
        path.write_text(text + "\n" * k)
        files.append(str(path))
        want += [(str(path), json.dumps(i, sort_keys=True)) for i in found]
    items, notes = B.json_records(spark, files)
    assert sorted((r.file, json.dumps(json.loads(r.item), sort_keys=True)) for r in items.collect()) == sorted(want) and not notes


HEADER = "hospital_name,license_number\nPlace,7\ndescription,code|1,code|1|type,setting,payer_name,standard_charge|negotiated_dollar\n"
ROW = '"Knee,\n""both""",326,APR-DRG,inpatient,Aetna,{}\n'


def test_broken_files_are_told_apart(spark, tmp_path, small_blocks, monkeypatch):
    small_blocks(64)
    rows = "".join(ROW.format(k) for k in range(1, 9))
    deep = json.dumps({"standard_charge_information": [{"description": "Knee", "code_information": [{"code": "326", "type": "APR-DRG"}], "standard_charges": [{"gross_charge": k}]} for k in range(4)]})
    texts = {
        "whole.csv": HEADER + rows, "bare.csv": (HEADER + rows).rstrip("\n"), "cell.csv": HEADER + rows + '"Knee, 326', "row.csv": HEADER + rows + "Knee,326,APR", "short.csv": HEADER + "Knee,326,APR", "none.csv": HEADER,
        "whole.json": deep, "cut.json": deep[: len(deep) // 2], "head.json": deep[:60],
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "binary.csv").write_bytes(bytes(range(256)) * 40)
    (tmp_path / "odd.csv").write_bytes((HEADER + rows).encode() + b"Knee \xff\x00,326,APR-DRG,inpatient,B,9\n")
    names = [*texts, "binary.csv", "odd.csv"]
    lines, status = P.load_prices(spark, {n: str(tmp_path / n) for n in names}, Settings())
    told = {s["source"]: (s["rows"], s["status"]) for s in status}
    assert {k: (n, s.split(":")[0]) for k, (n, s) in told.items()} == {
        "whole.csv": (8, "ok"), "bare.csv": (8, "ok"), "cell.csv": (8, "partial"), "row.csv": (8, "partial"), "short.csv": (0, "failed"), "none.csv": (0, "empty"),
        "whole.json": (4, "ok"), "cut.json": (1, "partial"), "head.json": (0, "failed"), "binary.csv": (0, "failed"), "odd.csv": (9, "ok"),
    }
    assert told["short.csv"][1].endswith(B.SHORT_ROW) and told["head.json"][1].endswith(B.OPEN_ITEM)
    assert {(r.description, r.negotiated) for r in lines.filter("source = 'whole.csv'").collect()} == {('Knee,\n"both"', float(k)) for k in range(1, 9)}


def test_a_quote_that_never_closes_stops_at_a_bound(spark, tmp_path, small_blocks, monkeypatch):
    monkeypatch.setattr(B, "MOST_CHARS", 300)
    small_blocks(128)
    path = tmp_path / "p.csv"
    path.write_text(HEADER + ROW.format(1) + '"' + "word 326\n" * 200)
    _, status = P.load_prices(spark, {"p": str(path)}, Settings())
    assert (status[0]["rows"], status[0]["status"]) == (1, "partial")


def fed(taker, data, separator, rng):
    """What comes of a text in batches of a random number of lines (of one each without ``rng``)."""
    lines = [x + separator for x in data.split(separator)[:-1]]
    while lines:
        n = rng.randrange(1, 9) if rng else 1
        for kind, text in taker.feed(b"".join(lines[:n])) or ():
            yield from [(B.RECORD, t.decode()) for t in text] if kind == B.MANY else [(kind, text)]
        lines = lines[n:]
    yield from taker.finish() if hasattr(taker, "finish") else ()


def test_batches_give_what_lines_give():
    rng = random.Random(7)
    for k in range(400):
        odd = ["5\" pipe,stray \"q\",x\n", 'a,"b"c"d,e\n', '"open\n', "\n", 'x\r"y\n', '"a"\r\n'][: k % 7]
        text = (made_csv(rng, 8) + "".join(rng.sample(odd, len(odd))) + made_csv(rng, 6)).encode()
        for state in (False, True):
            assert list(fed(B.CsvCutter(state), text, b"\n", rng)) == list(fed(B.CsvCutter(state), text, b"\n", None)), (text, state)
            assert B.inside_after_all(text, state) == (lambda s: [s := B.inside_after(x, s) for x in text.decode().split("\n")[:-1]][-1])(state)
        whole, _ = made_json(rng, 12)
        text = whole.encode() + b"}"
        at = rng.choice([i + 1 for i, c in enumerate(text) if c == 125])
        many, one = B.JsonSummary(), B.JsonSummary()
        assert not [*fed(many, text[:at], b"}", rng), *fed(one, text[:at], b"}", None)] and many.told() == one.told()
        state = B.JsonSummary.composed((0, 0, 0), many.told())
        for begin, s in ((0, (0, 0, 0)), (at, state)):
            assert list(fed(B.ItemCutter(s), text[begin:], b"}", rng)) == list(fed(B.ItemCutter(s), text[begin:], b"}", None)), (text, begin)


def test_plain_batches_do_not_go_line_by_line(monkeypatch):
    calls = []
    monkeypatch.setattr(B, "inside_after", lambda *a, was=B.inside_after: calls.append(1) or was(*a))
    monkeypatch.setattr(B.ItemScanner, "feed", lambda *a, was=B.ItemScanner.feed: calls.append(1) or was(*a))
    data = b'"joint,\n""other""",326,x\n' * 1000
    summary, cutter = B.CsvSummary(), B.CsvCutter(0)
    summary.feed(data)
    assert summary.told() == [0, 0] and sum(len(t) if k == B.MANY else 1 for k, t in cutter.feed(data)) == 1000 and len(calls) < 6
    items, calls[:] = b'{"description": "joint }] \\"both\\"", "c": [{"code": "326"}]},' * 1000, []
    assert sum(len(t) if k == B.MANY else 1 for k, t in B.ItemCutter((0, 2, 2)).feed(items[:-1])) == 1000 and not calls


def test_legacy_numbers_are_parsed_only_beside_their_words():
    able = B.Wanted(P.wanted_records(Settings()))
    assert [able(x) for x in (b"a,326,9", b"a,0470,9", b"a,4701,9", b"a,301,9", b"Joint\\nREPLACEMENT,301,9", b"arthroplasty,302", b"arthroplasty,3020", b'{"code": "\\u0033\\u0030\\u0031"}')] == [True, True, False, False, True, True, False, True]
    assert B.Wanted(None)(b"") and B.Wanted("470")(b"4701") and not B.Wanted("470")(b"47")
