import array
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from valuemark.llm import token_records as R
from valuemark.llm.encoders import encoder
from valuemark.session import fresh_path

BYTE = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "a", " a", "a ", "a  b", "a\tb", "\n\nx\n", "x \ny", "it's the dog's", "naïve café é", "<|endoftext|> b", "ß ﬁ Ω İ", "x y", "1 23 4,5", "日本 語", "a\x1cb c", "a " * 3000]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("limit", [3, 1000])
def test_chunks_give_the_librarys_ids(name, limit):
    path = public_tokenizers.path(name)
    library = Tokenizer.from_file(path)
    for text in ODD * 2:
        assert encoder(path, limit).ids(text) == array.array("I", library.encode(text, add_special_tokens=False).ids).tobytes(), text


def brute(rows):
    library, start, out = Tokenizer.from_file(BYTE), 0, []
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc_id, start, len(ids), zlib.crc32(array.array("I", ids).tobytes())))
        start += len(ids)
    return out


def digest(df):
    return sorted(tuple(r) for r in df.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("c")).collect())


def test_round_trip(spark, docs_of):
    rows = [(i * 7 - 20, t) for i, t in enumerate(ODD)] + [(500, None)]
    path = fresh_path(spark, "records")
    R.write_token_records(docs_of(rows).withColumn("file", F.lit(1)).withColumn("ids", F.lit("x")), path, BYTE, 0, file_bytes=300)
    assert digest(R.read_token_records(spark, path)) == brute(rows)
    assert spark.read.parquet(f"{path}/index").count() == len(rows)
    got = R.fetch(spark, path, spark.createDataFrame([(1,), (500,)], "doc_id long")).collect()
    assert sorted(r.doc_id for r in got) == [1, 500]


def test_repeated_and_null_ids_and_empty_table(spark, docs_of):
    path = fresh_path(spark, "records")
    R.write_token_records(docs_of([(1, "a b"), (1, "a b"), (None, "c")]), path, BYTE, 0)
    assert [r.doc_id for r in R.read_token_records(spark, path).orderBy("start").collect()] == [None, 1, 1]
    path = fresh_path(spark, "records")
    R.write_token_records(docs_of([]), path, BYTE, 0)
    assert R.read_token_records(spark, path).count() == 0


def test_damage_is_found():
    record = bytearray(R.frame(3, array.array("I", [5, 6]).tobytes(), 2))
    assert R.unframe(bytes(record)) == (3, array.array("I", [5, 6]).tobytes())
    record[12] ^= 1
    with pytest.raises(ValueError):
        R.unframe(bytes(record))
    record[0] ^= 1
    with pytest.raises(ValueError):
        list(R.spans(bytes(record)))


def test_query_reads_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in R.op9_token_records(spark, sf).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == brute(rows)
