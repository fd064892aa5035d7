"""Price-transparency files: tall CSV, wide CSV and JSON, each file with its own header, also packed as gzip or zip.

The first bytes of every file say how it is packed, its format, its header row and its metadata. Files of one
layout are read together as plain text columns, target codes are picked out, and only then are wide payer
columns turned into rows. Plain files, CSV and JSON, are cut into records block by block (``blocks``), so one large file
keeps all tasks busy; packed ones stream out of one read each.
"""

from __future__ import annotations

import csv
import functools
import gzip
import io
import json
import re
import struct
import zipfile
import zlib
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from valuemark.config import Settings
from valuemark.functions import scalars as S
from valuemark.session import materialize, ship
from valuemark.sources.blocks import OPEN_ITEM, ItemScanner, csv_records, json_records

#: Lines of a head that may be the header, bytes that are read for it, files whose heads are read at a time.
HEAD_LINES, HEAD_BYTES, HEADS_AT_ONCE = 10, 1 << 18, 16
BATCH_ROWS = 2000
PRICE_COLUMNS = ("facility_name", "ccn", "code", "system", "description", "setting", "payer", "plan", "gross", "cash", "negotiated", "least", "most", "source")


def sniff(head: str, hint: str) -> str:
    """csv or json: by the first character that is not blank, then by the name or what else is said of the file."""
    first = head.lstrip("﻿ \t\r\n")[:1]
    return "json" if first in ("{", "[") or (not first and re.search(r"\.json\b|application/json", hint.lower())) else "csv"


def unpacked_head(data: bytes, hint: str) -> tuple[str, str, str]:
    """How a file is packed (plain, gzip or zip, by its first bytes), its first text, and the name of a zip's first member."""
    if data[:4] == b"PK\x03\x04":
        how, size, extra = *struct.unpack("<H", data[8:10]), *struct.unpack("<HH", data[26:30])
        member, body = data[30 : 30 + size].decode("utf-8", "replace"), data[30 + size + extra :]
        text = zlib.decompressobj(-15).decompress(body, HEAD_BYTES) if how == 8 else body
        return "zip", text.decode("utf-8-sig", "replace"), member
    if data[:2] == b"\x1f\x8b":
        return "gzip", zlib.decompressobj(31).decompress(data, HEAD_BYTES).decode("utf-8-sig", "replace"), ""
    return "plain", data.decode("utf-8-sig", "replace"), ""


def layout(head: str) -> dict:
    """Header row, columns and metadata of a CSV head; an error where no header is found."""
    rows = list(csv.reader(io.StringIO(head.lstrip("﻿"))))[:HEAD_LINES]
    for at, row in enumerate(rows):
        names = [c.strip().lower() for c in row]
        if "description" in names and any(c == "code" or c.startswith(("code|", "standard_charge")) for c in names):
            meta = dict(zip([c.strip().lower() for c in rows[0]], rows[1])) if at >= 2 else {}
            ccn = next((meta[k].strip() for k in ("license_number", "cms_certification_number", "ccn") if meta.get(k, "").strip()), None)
            return {"row": at, "names": [c.strip() for c in row], "facility": meta.get("hospital_name", "").strip() or None, "ccn": ccn}
    raise ValueError("no header row with a description and a code or charge column")


def _head(spark: SparkSession, path: str) -> bytes:
    """The first bytes of a file, through whatever file system Spark reads it with."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).open(where)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(jvm.org.apache.commons.io.input.BoundedInputStream(stream, HEAD_BYTES)))
    finally:
        stream.close()


def _last_byte(spark: SparkSession, path: str) -> bytes:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    size = store.getFileStatus(where).getLen()
    stream = store.open(where)
    try:
        stream.seek(max(0, size - 1))
        return bytes([stream.read() & 0xFF]) if size else b""
    finally:
        stream.close()


def probe(spark: SparkSession, paths: list[str], hints: dict[str, str] | None = None) -> tuple[list[dict], dict[str, str]]:
    """Packing, format and layout of every file, and what is wrong with the files that have none.

    A quarter of a megabyte of each file and its last byte are read, as a listing would; nothing else of it. ``hints`` has
    what a server says of a path (content type, disposition).
    """
    found, failed = [], {}

    def one(path: str) -> dict:
        hint = f"{path} {(hints or {}).get(path, '')}"
        packed, head, member = unpacked_head(_head(spark, path), hint)
        kind = sniff(head, f"{hint} {member}")
        told = layout(head) | {"ended": packed != "plain" or _last_byte(spark, path) in (b"\n", b"\r")} if kind == "csv" else {}
        return {"file": path, "packed": packed, "kind": kind} | told

    def told(path: str) -> tuple[str, dict | str]:
        try:
            return path, one(path)
        except Exception as e:  # one bad file must not stop the others
            return path, str(e).splitlines()[0]

    with ThreadPoolExecutor(HEADS_AT_ONCE) as pool:
        for path, got in pool.map(told, paths):
            if isinstance(got, dict):
                found.append(got)
            else:
                failed[path] = got
    return found, failed


def target_digits(s: Settings) -> str:
    """A pattern that every target code has: what lacks it is settled before any other pattern is tried."""
    return "|".join(sorted({c.lstrip("0") for c in (s.ms_code, *s.apr_codes, *s.apr_legacy_codes)}))


def wanted_records(s: Settings) -> list[tuple[str, ...]]:
    """Patterns, one tuple of which every record of a target has: no digit follows its number, and a legacy number stands beside
    words of its description. A record that spells letters or digits as JSON escapes may have either."""
    of = lambda codes: f"(?:{'|'.join(sorted({c.lstrip('0') for c in codes}))})(?![0-9])"
    return [(of((s.ms_code, *s.apr_codes)),), (of(s.apr_legacy_codes), S.LEGACY_WORDS), (r"\\u00",)]


def _targets(pairs: list[tuple[Column, Column]], description: Column, s: Settings) -> Column:
    """The first code of a row that is a target, as a list of struct(system, number) with one element, or none.

    Rows are to be made of it: a filter on a column of it would be pushed below, and all patterns be tried twice.
    """
    classified = F.array(*[F.when(c.rlike(target_digits(s)), S.classify_code(c, t)) for c, t in pairs])
    return F.slice(F.filter(classified, lambda x: x.isNotNull() & S.is_target_code(x, description, s)), 1, 1)


def code_columns(names: list[str]) -> list[tuple[str, str | None]]:
    codes = [n for n in names if n == "code" or (n.startswith("code|") and n.count("|") == 1)]
    return [(n, f"{n}|type" if f"{n}|type" in names else None) for n in codes]


def parse_csv(raw: DataFrame, names: list[str], facility: str | None, ccn: str | None, label: str, s: Settings) -> DataFrame:
    """Target lines of one layout. ``raw`` has its columns in order, all text; the preamble rows have no target code and fall out."""
    own = {"facility_name": F.lit(facility or label), "ccn": F.lit(ccn).cast("string"), "source": F.lit(label)}
    return csv_lines(raw.toDF(*[f"c{i}" for i in range(len(names))]).withColumns(own), names, s).drop("file")


def csv_lines(df: DataFrame, names: list[str], s: Settings) -> DataFrame:
    """Target lines of files of one layout: c0, c1, ... hold its columns, facility_name, ccn, source (and file) what is said of each file."""
    columns = [f"c{i}" for i in range(len(names))]
    payers = {n.lower(): n.split("|") for n in names}  # payer and plan keep their spelling
    names = [n.lower() for n in names]
    of = dict(zip(names, columns))
    get = lambda *wanted: F.coalesce(*[F.col(of[w]) for w in wanted if w in of], F.lit(None).cast("string"))
    description = get("description")
    pairs = [(F.col(of[c]), F.col(of[t]) if t else F.lit(None).cast("string")) for c, t in code_columns(names)]
    rows = df.withColumn("target", F.explode(_targets(pairs, description, s)))
    wide = [(n, payers[n]) for n in names if n.startswith("standard_charge|") and n.count("|") == 3]
    amount = lambda n: S.clean_currency(F.col(of[n]))
    if wide:
        offers = F.array(*[F.struct(F.lit(p[1]).alias("payer"), F.lit(p[2]).alias("plan"), amount(n).alias("negotiated")) for n, p in wide if p[3].lower() == "negotiated_dollar"])
        none = F.array(F.struct(F.lit(None).cast("string").alias("payer"), F.lit(None).cast("string").alias("plan"), F.lit(None).cast("double").alias("negotiated")))
        paid = F.filter(offers, lambda x: x["negotiated"].isNotNull())
        rows = rows.withColumn("offer", F.explode(F.when(F.size(paid) > 0, paid).otherwise(none)))
        payer, plan, negotiated = F.col("offer.payer"), F.col("offer.plan"), F.col("offer.negotiated")
    else:
        priced = [n for n in ("standard_charge|negotiated_dollar", "standard_charge|negotiated") if n in of]
        payer, plan = S.blank_to_null(get("payer_name")), S.blank_to_null(get("plan_name"))
        negotiated = amount(priced[0]) if priced else F.lit(None).cast("double")
    money = lambda *wanted: S.clean_currency(get(*wanted))
    return rows.select(
        *[c for c in ("file",) if c in df.columns], "facility_name", "ccn", F.col("target.number").alias("code"), F.col("target.system").alias("system"), description.alias("description"), S.blank_to_null(get("setting")).alias("setting"),
        payer.alias("payer"), plan.alias("plan"), money("standard_charge|gross").alias("gross"), money("standard_charge|discounted_cash").alias("cash"), negotiated.alias("negotiated"), money("standard_charge|min").alias("least"), money("standard_charge|max").alias("most"), "source",
    )


JSON_ITEM = (
    "description: STRING, code_information: ARRAY<STRUCT<code: STRING, type: STRING>>, standard_charges: ARRAY<STRUCT<setting: STRING, gross_charge: STRING, discounted_cash: STRING, minimum: STRING, maximum: STRING, "
    "payers_information: ARRAY<STRUCT<payer_name: STRING, plan_name: STRING, standard_charge_dollar: STRING>>>>"
)


def parse_json_items(items: DataFrame, label: str, s: Settings) -> DataFrame:
    """Charge items (columns of JSON_ITEM) of one source to price lines."""
    return json_lines(items.withColumns({"facility_name": F.lit(label), "source": F.lit(label)}), s).drop("file")


def json_lines(items: DataFrame, s: Settings) -> DataFrame:
    """Charge items, with facility_name and source, to price lines: first target code, charges, payers or one line without."""
    able = F.filter("code_information", lambda c: c["code"].rlike(target_digits(s)))
    codes = F.transform(able, lambda c: S.classify_code(c["code"], c["type"]))
    target = F.slice(F.filter(codes, lambda x: x.isNotNull() & S.is_target_code(x, F.col("description"), s)), 1, 1)
    own = [c for c in ("file", "facility_name", "source") if c in items.columns]
    rows = items.withColumn("target", F.explode(target)).select(*own, "description", "target", F.explode("standard_charges").alias("c")).select("*", F.explode_outer("c.payers_information").alias("p"))
    money = lambda c: S.clean_currency(F.col(c))
    return rows.select(
        *[c for c in own if c != "source"], F.lit(None).cast("string").alias("ccn"), F.col("target.number").alias("code"), F.col("target.system").alias("system"), "description", S.blank_to_null(F.col("c.setting")).alias("setting"), F.col("p.payer_name").alias("payer"), F.col("p.plan_name").alias("plan"),
        money("c.gross_charge").alias("gross"), money("c.discounted_cash").alias("cash"), money("p.standard_charge_dollar").alias("negotiated"), money("c.minimum").alias("least"), money("c.maximum").alias("most"), "source",
    )


ITEM_ROW = "file string, item string, note string"


def _item_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (zip(*rows) if rows else [()] * 3)], ["file", "item", "note"])


def _opened(content: bytes, packed: str):
    if packed == "gzip":
        return gzip.open(io.BytesIO(content))
    archive = zipfile.ZipFile(io.BytesIO(content))
    named = [n for n in archive.namelist() if n.lower().endswith((".csv", ".json"))]
    if not named:
        raise ValueError("no .csv or .json in the archive")
    return archive.open(named[0])


def _unpacked(batches, packed: dict[str, str], kinds: dict[str, str]):
    """Charge items (as text) or CSV rows (as a JSON list of cells) of packed files; what fails on the way is a note."""
    for b in batches:
        for file, content in zip(b.column("file").to_pylist(), b.column("content").to_pylist()):
            rows = []
            try:
                with io.TextIOWrapper(_opened(content, packed[file]), encoding="utf-8-sig", errors="replace", newline="") as text:
                    scanner = ItemScanner()
                    parts = (x for part in iter(functools.partial(text.read, 1 << 16), "") for x in scanner.feed(part)) if kinds[file] == "json" else (json.dumps(r) for r in csv.reader(text))
                    for x in parts:
                        rows.append((file, x, None))
                        if len(rows) >= BATCH_ROWS:
                            yield _item_batch(rows)
                            rows = []
                    if not scanner.whole:
                        rows.append((file, None, OPEN_ITEM))
            except (ValueError, OSError, EOFError, zlib.error, zipfile.BadZipFile, csv.Error) as e:
                rows.append((file, None, str(e).splitlines()[0]))
            yield _item_batch(rows)


def _packed_rows(spark: SparkSession, files: list[dict]) -> DataFrame:
    """A packed file is read whole, as its format demands; what it holds streams."""
    ship(spark)
    binary = spark.read.format("binaryFile").load([f["file"] for f in files]).select(_given(files), "content")
    unpack = functools.partial(_unpacked, packed={f["file"]: f["packed"] for f in files}, kinds={f["file"]: f["kind"] for f in files})
    return binary.mapInArrow(unpack, ITEM_ROW)


def _given(files: list[dict]) -> Column:
    """The path of a row's file as it was given: what Spark reports has a scheme and may be escaped."""
    tail = lambda c: F.regexp_replace(c, "^[a-z0-9]+:/*", "/")
    names = F.create_map(*[x for f in files for x in (tail(F.lit(f["file"])), F.lit(f["file"]))])
    return F.coalesce(names[tail(F.col("_metadata.file_path"))], names[tail(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))]).alias("file")


def load_prices(spark: SparkSession, labels: dict[str, str], s: Settings, max_rows: int | None = None, hints: dict[str, str] | None = None) -> tuple[DataFrame | None, list[dict]]:
    """Price lines of all files (label -> path) and a status row for each: ok, partial, empty or failed.

    Files are read together, one branch for each CSV layout and one for all JSON; what came of a file is counted
    once over the written lines. A file is partial if it is cut at ``max_rows`` or breaks off (within a quoted cell, a
    last row with fewer cells than the header and no line end, an item, a packed stream); it fails if it breaks
    before any line, or has no header. What is wrong with one file leaves the others alone.
    """
    found, failed = probe(spark, list(dict.fromkeys(labels.values())), hints)
    label_of: dict[str, list[str]] = {}
    for label, path in labels.items():
        label_of.setdefault(path, []).append(label)
    facts = [(f["file"], label, f.get("facility") or label, f.get("ccn")) for f in found for label in label_of[f["file"]]]
    about = F.broadcast(spark.createDataFrame(facts, "file string, source string, facility_name string, ccn string"))  # a row a file
    parts, notes = [], None
    layouts: dict[tuple, list[dict]] = {}
    for f in found:
        layouts.setdefault(("json",) if f["kind"] == "json" else tuple(f["names"]), []).append(f)
    broken: dict[str, str] = {}
    wanted = wanted_records(s)
    for key, files in layouts.items():
        natively = [f for f in files if f["packed"] == "plain" or (f["packed"] == "gzip" and f["file"].endswith(".gz"))]
        others = [f for f in files if f not in natively]
        read = []
        if others:
            rows = materialize(_packed_rows(spark, others), "rows")
            told = rows.filter("note IS NOT NULL").select("file", "note")
            notes = told if notes is None else notes.unionByName(told)
            read.append(rows.filter("item IS NOT NULL").select("file", "item"))
        if key == ("json",):
            if natively:
                items, faults = json_records(spark, [f["file"] for f in natively], wanted)
                read.append(items)
                broken |= faults
            parsed = functools.reduce(DataFrame.unionByName, read).select("file", F.from_json("item", f"struct<{JSON_ITEM}>").alias("i")).select("file", "i.*")
            parts.append(json_lines(parsed.join(about, "file"), s))
        else:
            read = [r.select("file", F.from_json("item", "array<string>").alias("cells")) for r in read]
            if natively:
                records, faults = csv_records(spark, {f["file"]: None if f["ended"] else len(f["names"]) for f in natively}, wanted)
                read.append(records)
                broken |= faults
            cells = functools.reduce(DataFrame.unionByName, read).join(about, "file")
            parts.append(csv_lines(cells.select("*", *[F.get("cells", i).alias(f"c{i}") for i in range(len(key))]).drop("cells"), list(key), s))
    whole = None
    counts: dict[tuple[str, str], int] = {}
    broken |= {r.file: r.note for r in notes.groupBy("file").agg(F.min("note").alias("note")).collect()} if notes is not None else {}
    if parts:
        lines = functools.reduce(DataFrame.unionByName, parts)
        if max_rows:
            order = Window.partitionBy("file", "source").orderBy("at")
            lines = lines.withColumn("at", F.monotonically_increasing_id()).withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= max_rows + 1)
        lines = materialize(lines, "price-lines")
        counts = {(r.source, r.file): r["count"] for r in lines.groupBy("source", "file").count().collect()}  # a row a file
        whole = lines.filter(F.col("nth") <= max_rows) if max_rows else lines
        whole = whole.select(*PRICE_COLUMNS)
    status = []
    for label, path in labels.items():
        n = counts.get((label, path), 0)
        cut = bool(max_rows) and n > max_rows
        n = min(n, max_rows) if max_rows else n
        why = failed.get(path) or (broken.get(path) if not n else None)
        status.append({"source": label, "file": path, "rows": n, "status": f"failed: {why}" if why else "partial" if cut or path in broken else "ok" if n else "empty"})
    return whole, status


def manifest_locations(texts: DataFrame) -> DataFrame:
    """Blocks of ``key: value`` lines (columns base, body) as rows: location_name, mrf_url, contact_name.

    A repeated location name or URL starts a new block; a block without a URL is dropped; HTML pages are no
    manifests; relative URLs are resolved against ``base``.
    """
    plain = texts.filter(~F.lower(F.substring("body", 1, 2000)).contains("<html"))
    lines = F.filter(F.transform(F.split("body", r"\r?\n"), lambda x: S.strip(x)), lambda x: (x != "") & ~x.startswith("#") & x.contains(":"))
    parsed = F.transform(lines, lambda x: F.struct(F.lower(S.strip(F.substring_index(x, ":", 1))).alias("k"), S.strip(F.substring(x, F.instr(x, ":") + 1, F.length(x))).alias("v")))
    empty = "named_struct('done', CAST(array() AS ARRAY<STRUCT<n: STRING, u: STRING, c: STRING>>), 'n', CAST(NULL AS STRING), 'u', CAST(NULL AS STRING), 'c', CAST(NULL AS STRING))"

    def step(acc: Column, x: Column) -> Column:
        name, url = x["k"] == "location-name", x["k"] == "mrf-url"
        fresh = (name & acc["n"].isNotNull()) | (url & acc["u"].isNotNull())
        done = F.when(fresh, F.concat(acc["done"], F.array(F.struct(acc["n"].alias("n"), acc["u"].alias("u"), acc["c"].alias("c"))))).otherwise(acc["done"])
        keep = lambda f: F.when(fresh, F.lit(None).cast("string")).otherwise(acc[f])
        return F.struct(done.alias("done"), F.when(name, x["v"]).otherwise(keep("n")).alias("n"), F.when(url, x["v"]).otherwise(keep("u")).alias("u"), F.when(x["k"] == "contact-name", x["v"]).otherwise(keep("c")).alias("c"))

    blocks = F.aggregate(parsed, F.expr(empty), step, lambda acc: F.concat(acc["done"], F.array(F.struct(acc["n"].alias("n"), acc["u"].alias("u"), acc["c"].alias("c")))))
    rows = plain.select("base", F.explode(blocks).alias("b")).filter("b.u IS NOT NULL AND b.u <> ''")
    return rows.select("base", F.col("b.n").alias("location_name"), S.resolved_url(F.col("b.u"), F.col("base")).alias("mrf_url"), F.col("b.c").alias("contact_name"))


def price_targets(targets: DataFrame, discovered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Where each system's file is (a manual URL beats discovery), and the systems that have neither."""
    rows = targets.select(*[S.strip(F.col(c).cast("string")).alias(c) for c in targets.columns]).filter("system_name <> ''")
    manual = F.nullif(F.col("manual_mrf_url"), F.lit(""))
    joined = rows.join(discovered.select(F.col("system_name").alias("s"), "location_name", "mrf_url"), F.col("system_name") == F.col("s"), "left").drop("s")
    done = joined.withColumn("url", F.coalesce(manual, "mrf_url"))
    return done.filter("url IS NOT NULL").drop("mrf_url").distinct(), done.filter("url IS NULL").select("system_name").distinct()


def json_items(df: DataFrame, column: str) -> DataFrame:
    """Charge items out of a column of JSON objects."""
    return df.select(F.from_json(column, f"struct<{JSON_ITEM}>").alias("i")).select("i.*")
