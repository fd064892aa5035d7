import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from valuemark.llm import pieces as P

PATH = public_tokenizers.path("piece_bpe_32k.model")
SP = sentencepiece.SentencePieceProcessor(model_file=PATH)
ODD = ["", " ", "a", "\n", "a\nb", "  a", "a  b", "▁a", "a▁b", "日本語 𝒳", "aaa\t", "\x00a", "<s> </s>", "é", " \n ", "\n\n", "a \nb", "a\n b", "x " * 5000, "z" * 4000]


@given(st.text(alphabet="abtheÉß日\n\t ▁𝒳.", max_size=40))
@settings(max_examples=300, deadline=None)
def test_agenda_alone_equals_the_library(text):
    model = P.piece_model(PATH)
    marked = "▁" + text.replace(" ", "▁")
    assert (model.agenda_ids(marked) if text else []) == SP.encode(text)


@pytest.mark.parametrize("limit", [2, 1000])
def test_words_equal_the_library(limit):
    model = P.piece_model(PATH, limit)
    for text in ODD * 2:
        ((ids, spelled, _),) = model.encode([text])
        assert ids == SP.encode(text, add_eos=True), text
        assert spelled == " ".join(map(str, ids))


def test_the_agenda_leads_and_where_it_differs_is_told(monkeypatch):
    model = P.PieceModel(PATH, 10)
    assert [own for _, _, own in model.encode(["there they are", "a \u2163 b", "plain words"])] == [True] * 3
    monkeypatch.setattr(model, "agenda_ids", lambda marked: [7])
    assert model.encode(["others"]) == [(SP.encode("others", add_eos=True), " ".join(map(str, SP.encode("others", add_eos=True))), False)]


def test_query_rows(spark, docs_of):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(99, None), (1, "a"), (None, "b")]
    got = P.piece_coding(docs_of(rows).selectExpr("*", "1 AS ids", "'x' AS decoded"), PATH).collect()
    want = [(d, SP.encode(t or "", add_eos=True)) for d, t in rows]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted(((r.doc_id, r.n_tokens, r.ids, r.decoded) for r in got), key=key) == sorted(((d, len(i), " ".join(map(str, i)), SP.decode(i)) for d, i in want), key=key)
    assert P.piece_coding(docs_of([]), PATH).count() == 0


def test_query_reads_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in P.op6_pieces(spark, sf).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = SP.encode(r.text or "", add_eos=True)
        assert got[r.doc_id] == (len(ids), sha(" ".join(map(str, ids))), sha(SP.decode(ids)))


def test_both_agendas_merge_alike():
    model = P.piece_model(PATH)
    for text in [*ODD[:-2], "aaaaaaaa", "thathaon,", "auxçaimentement", "the" * 14, "ab" * 20 + "é" * 5]:
        assert P.merged_short(list(text), model.cost) == P.merged(list(text), model.cost), text


def test_each_different_word_is_looked_up_once():
    model, asked = P.PieceModel(PATH, 1000), []
    model.numbers = lambda words, was=model.numbers: asked.append(words) or was(words)
    texts = ["a b a b\na", "", " a  b", "b a", "\n\nb"]
    assert [ids for ids, _, _ in model.encode(texts)] == [SP.encode(t, add_eos=True) for t in texts]
    assert len(asked) == 1 and len(asked[0]) == len(set(asked[0]))
