"""Line deduplication by winnowing.

A passage is a run of lines, blank ones aside, of at least ``min_chars`` characters. From every line on, the
shortest passage that starts there is a window, and so is the shortest that ends at a line; the least line hash
in a window is its fingerprint. Two equal passages hold an equal window and so an equal fingerprint: none is
missed. Neighbouring windows share their minimum, so a document has far fewer fingerprints than lines.

1. The fingerprints, each with its position, are counted; those that stand at two positions or more are seeds.
2. Positions that share a seed are joined, through the lines around them: a seed is extended to the left and to
   the right by every window that it is the minimum of, and a window meets the first one of equal lines.
3. Matched windows that follow one another, here and where they stood first, are one match extended both ways:
   they merge into the longest equal run.
4. Lines of runs that have stood earlier (by document id, then line) are deleted: of every repeated run the
   first stays and later ones go.

Everything is DataFrame functions. Rows that agree in id and text are one document. No pair of positions is
ever made: every step is a grouping with partial minima or a join with one row per key, both sides of which are
written tables, so that Spark splits a passage that very many documents share among tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from valuemark.llm.common import materialize, table, unused

MIN_CHARS = 160
#: Lines and passages are told apart by 128 bits: a plain hash and one behind this number.
SECOND = 20240601
#: A document: whether it has an id, the id or 0, and the hash of its text.
DOC = ("known", "id", "th")


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """Documents and their lines with content: two hashes, length, line number from 0."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    hashed = F.transform(F.split(text, "\n"), lambda x, i: F.struct(F.xxhash64(x).alias("h"), F.xxhash64(F.lit(SECOND), x).alias("g"), F.when(F.length(F.trim(x)) > 0, F.length(x)).otherwise(0).cast("long").alias("size"), i.alias("pos")))
    lines = F.when(F.length(text) >= min_chars, F.filter(hashed, lambda x: x["size"] > 0))
    described = docs.select(doc_id.isNotNull().alias("known"), F.coalesce(doc_id, F.lit(0)).alias("id"), F.xxhash64(text).alias("th"), lines.alias("lines")).filter(F.col("lines").isNotNull())
    return described.groupBy(*DOC).agg(F.first("lines").alias("lines"))


def _windows(lined: DataFrame, min_chars: int, *kept: str) -> DataFrame:
    """Every complete window: its first and last line (number, and ``nth`` among those with content), print (least hash) and its place, content (two hashes of all lines)."""
    doc = Window.partitionBy(*DOC)
    lines = lined.select(*DOC, *kept, F.posexplode("lines").alias("nth", "line")).select(*DOC, *kept, "nth", "line.*")
    placed = lines.withColumn("until", F.sum("size").over(doc.orderBy("nth").rowsBetween(Window.unboundedPreceding, 0))).withColumn("begin", F.col("until") - F.col("size")).withColumn("total", F.sum("size").over(doc))
    ahead = doc.orderBy("begin").rangeBetween(0, min_chars - 1)
    behind = doc.orderBy("until").rangeBetween(1 - min_chars, 0)

    def side(frame: Window, complete) -> DataFrame:
        found = placed.select(*DOC, *kept, F.collect_list(F.struct("h", "pos", "nth", "g")).over(frame).alias("held"), complete.alias("complete")).filter("complete")
        least, first, last = F.array_min("held"), F.element_at("held", 1), F.element_at("held", -1)
        content = F.struct(*[F.xxhash64(F.size("held"), F.col(f"held.{c}")).alias(c) for c in ("h", "g")])
        return found.select(
            *DOC, *kept, first["pos"].alias("from_pos"), last["pos"].alias("to_pos"), first["nth"].alias("from_nth"), last["nth"].alias("to_nth"),
            least["h"].alias("print"), least["pos"].alias("print_pos"), content.alias("content"),
        )

    return side(ahead, F.col("total") - F.col("begin") >= min_chars).unionByName(side(behind, F.col("until") >= min_chars))


def repeated_runs(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Every later run: its document (known, id, th), from_pos and to_pos (line numbers from 0), and first (the document and line where it stood first).

    Null texts count as empty; an empty table, and one without repeated runs, gives no rows.
    """
    once = materialize(_lines(docs, min_chars), "lines")
    prints = materialize(_windows(once, min_chars).select(*DOC, "print", "print_pos").distinct(), "prints")
    spot = F.struct(*DOC, "print_pos")
    repeated = prints.groupBy("print").agg(F.min(spot).alias("one"), F.max(spot).alias("other")).filter("one <> other").select("print")
    seeds = prints.join(materialize(repeated, "repeated"), "print", "left_semi").groupBy(*DOC).agg(F.collect_set("print_pos").alias("seeds"))
    around = _windows(once.join(seeds, list(DOC)), min_chars, "seeds").filter(F.array_contains("seeds", F.col("print_pos")))
    around = materialize(around.select(*DOC, "from_pos", "to_pos", "from_nth", "to_nth", "content"), "around")
    place = F.struct(*DOC, "from_nth", "from_pos")
    first = around.groupBy("content").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").select("content", "first")
    matched = around.join(materialize(first, "first"), "content").filter(place != F.col("first"))
    # On a diagonal, places here and there move in step; a window that begins within what was matched before goes on with its run.
    diagonal = [*DOC, "first.known", "first.id", "first.th", F.col("from_nth") - F.col("first.from_nth")]
    before = Window.partitionBy(*diagonal).orderBy("from_nth", "to_nth").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce(F.col("from_nth") > F.max("to_nth").over(before) + 1, F.lit(True))
    run = F.sum(F.col("begins").cast("int")).over(Window.partitionBy(*diagonal).orderBy("from_nth", "to_nth").rowsBetween(Window.unboundedPreceding, 0))
    runs = matched.withColumn("begins", begins).withColumn("run", run).withColumn("shift", F.col("from_nth") - F.col("first.from_nth"))
    source = F.min(F.struct("first.from_nth", F.col("first.from_pos").alias("line")))["line"]
    found = runs.groupBy(*DOC, F.col("first.known").alias("first_known"), F.col("first.id").alias("first_id"), F.col("first.th").alias("first_th"), "shift", "run")
    return found.agg(F.min("from_pos").alias("from_pos"), F.max("to_pos").alias("to_pos"), source.alias("first_pos")).drop("shift", "run")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, counts: tuple[str, str] = ("n_lines", "removed_lines")) -> DataFrame:
    """Every row of ``docs`` with its own columns, the text without later repeated runs, and two ``counts``: its lines, and those removed.

    A row without a repeated run keeps its text as it is, null included; where every line with content goes,
    the text becomes empty. Blank lines between deleted ones go with them. Null ids come before all others.
    Columns of ``docs`` may have any names; those that are named like the counts are replaced.
    """
    key, names = unused(docs.columns, *DOC), unused(docs.columns, "gone")
    gone = repeated_runs(docs, min_chars).select(*DOC, F.explode(F.sequence("from_pos", "to_pos")).alias("pos")).groupBy(*DOC).agg(F.collect_set("pos").alias("gone"))
    gone = gone.toDF(*key, *names)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    joined = docs.withColumns(dict(zip(key, (doc_id.isNotNull(), F.coalesce(doc_id, F.lit(0)), F.xxhash64(text))))).join(gone, key, "left")
    lines, taken = F.split("text", "\n"), F.col(names[0])
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), taken)
    rest = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    rest = F.when(F.length(F.trim(F.translate(rest, "\n\t\r", ""))) > 0, rest).otherwise(F.lit(""))
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", *counts)]
    return joined.select(
        *own,
        F.when(taken.isNull(), F.col("text")).otherwise(rest).alias("text"),
        F.size(F.split(text, "\n")).alias(counts[0]),
        F.coalesce(F.size(taken), F.lit(0)).alias(counts[1]),
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "removed_lines")


OP5_SQL = f"""
WITH split_up AS (
  SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS pos
  FROM (SELECT DISTINCT doc_id, text FROM documents)
), sized AS (
  SELECT doc_id, text, pos, line, length(line) AS size FROM split_up WHERE length(trim(line, ' ')) > 0
), placed AS (
  SELECT *, sum(size) OVER (PARTITION BY doc_id, text ORDER BY pos) AS until, sum(size) OVER (PARTITION BY doc_id, text) AS total FROM sized
), windows AS (
  SELECT doc_id, text, list(line) OVER w AS content, min(pos) OVER w AS from_pos, max(pos) OVER w AS to_pos, total - (until - size) >= {MIN_CHARS} AS complete
  FROM placed WINDOW w AS (PARTITION BY doc_id, text ORDER BY until - size RANGE BETWEEN CURRENT ROW AND {MIN_CHARS - 1} FOLLOWING)
  UNION ALL
  SELECT doc_id, text, list(line) OVER w AS content, min(pos) OVER w AS from_pos, max(pos) OVER w AS to_pos, until >= {MIN_CHARS} AS complete
  FROM placed WINDOW w AS (PARTITION BY doc_id, text ORDER BY until RANGE BETWEEN {MIN_CHARS - 1} PRECEDING AND CURRENT ROW)
), ranked AS (
  SELECT doc_id, text, from_pos, to_pos, rank() OVER (PARTITION BY content ORDER BY doc_id, from_pos) AS k FROM windows WHERE complete
), gone AS (
  SELECT DISTINCT doc_id, text, unnest(generate_series(from_pos, to_pos)) AS pos FROM ranked WHERE k > 1
), removed AS (
  SELECT doc_id, text, count(*) AS n FROM gone GROUP BY ALL
), kept AS (
  SELECT s.doc_id, s.text, string_agg(s.line, chr(10) ORDER BY s.pos) AS rest
  FROM split_up s ANTI JOIN gone g ON s.doc_id = g.doc_id AND s.text = g.text AND s.pos = g.pos GROUP BY ALL
)
SELECT d.doc_id,
  CASE WHEN r.n IS NULL THEN d.text WHEN trim(replace(coalesce(k.rest, ''), chr(10), ''), ' ') = '' THEN '' ELSE k.rest END AS text,
  CAST(len(string_split(coalesce(d.text, ''), chr(10))) AS INTEGER) AS n_lines, CAST(coalesce(r.n, 0) AS INTEGER) AS removed_lines
FROM documents d LEFT JOIN removed r ON d.doc_id = r.doc_id AND d.text = r.text LEFT JOIN kept k ON d.doc_id = k.doc_id AND d.text = k.text
"""
