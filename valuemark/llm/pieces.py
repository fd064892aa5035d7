"""SentencePiece encoding and decoding for merge-type vocabularies.

A text becomes a row of symbols, one a character. An agenda holds every adjacent pair that spells a piece
of the vocabulary, ordered by the piece's score, then by place; the best pair is merged, pairs that it made
stale are passed over, and its new neighbours enter the agenda, until nothing is left to merge. The agenda of a
short word is a list of the costs of its pairs by place, of which the least and leftmost is taken. A symbol
outside the vocabulary becomes its UTF-8 bytes. No piece holds a word mark or a line end behind another
character, so merging works on words. A worker keeps their ids in two generations of bounded size: when the
young one is full it becomes the old one, and what is still in use moves on from there.

The ids are the agenda's. Each Arrow batch is checked against the library: the ids of all words that are new to the
worker in one call, and the round trip of every text. The library drops or changes some characters before it merges,
which is not built here; a word whose ids differ takes the library's, and a text that does not come back whole is
encoded by the library. Such texts are told apart (``by_agenda`` is false), so their number is a figure and not the
end of a job.
"""

from __future__ import annotations

import functools
import re
from array import array
from heapq import heapify, heappop, heappush
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuemark.llm.common import laid_out, row_starts, table, texts, worker_state

MARK = "▁"
RUNS = re.compile(f"{MARK}+[^{MARK}]*")
BATCH_CHARS = 1 << 20

def piece_model(path: str, limit: int = 300_000) -> "PieceModel":
    return worker_state(("pieces", path, limit), functools.partial(PieceModel, path, limit))


#: Symbols up to which an agenda is a list in the order of the text; NEVER is the cost of a pair that is no piece.
SHORT, NEVER = 48, float("inf")


def merged_short(symbols: list[str], cost: dict[str, float]) -> list[str]:
    """As ``merged``, by an agenda without stale pairs: the costs of all that are adjacent, searched from the left for the best."""
    find = cost.get
    agenda = [find(pair, NEVER) for pair in map(add, symbols, symbols[1:])]
    while agenda and (best := min(agenda)) != NEVER:
        i = agenda.index(best)
        new = symbols[i] = symbols[i] + symbols.pop(i + 1)
        del agenda[i]
        if i < len(agenda):
            agenda[i] = find(new + symbols[i + 1], NEVER)
        if i:
            agenda[i - 1] = find(symbols[i - 1] + new, NEVER)
    return symbols


def merged(symbols: list[str], cost: dict[str, float]) -> list[str]:
    """The symbols left when the agenda is empty; ``cost`` of a piece is its score turned round."""
    n, find = len(symbols), cost.get
    agenda = [(c, i, i + 1, pair) for i, pair in enumerate(map(add, symbols, symbols[1:])) if (c := find(pair)) is not None]
    heapify(agenda)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while agenda:
        _, left, right, pair = heappop(agenda)
        a, b = symbols[left], symbols[right]
        if not a or not b or len(a) + len(b) != len(pair):
            continue
        symbols[left], symbols[right] = pair, ""
        right = after[left] = after[right]
        if right < n:
            before[right] = left
            new = pair + symbols[right]
            if (c := find(new)) is not None:
                heappush(agenda, (c, left, right, new))
        right, left = left, before[left]
        if left >= 0:
            new = symbols[left] + pair
            if (c := find(new)) is not None:
                heappush(agenda, (c, left, right, new))
    return [s for s in symbols if s]


class PieceModel:
    def __init__(self, path: str, limit: int):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.ids_of_piece = {sp.id_to_piece(i): i for i in normal}
        self.cost = {p: -sp.get_score(i) for p, i in self.ids_of_piece.items()}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.end = sp.eos_id()
        self.by_word = not any("\n" in p or MARK in p.lstrip(MARK) for p in self.ids_of_piece)
        # Bytes and strings, which the garbage collector need not visit.
        self.limit, self.known, self.old = limit, {}, {}
        #: Kept words whose ids are the library's.
        self.changed: set[str] = set()

    def agenda_ids(self, marked: str) -> list[int]:
        """Ids of a text whose spaces are marks already."""
        out = []
        for s in (merged_short if len(marked) <= SHORT else merged)(list(marked), self.cost):
            known = self.ids_of_piece.get(s)
            if known is None:
                out.extend(self.bytes[b] for b in s.encode("utf-8", "surrogatepass"))
            else:
                out.append(known)
        return out

    def words(self, texts: list[str]) -> pa.Array:
        """Keys of the words of each text: a plain key has its mark left out; a key led by a line end or a mark is spelled in full."""
        spaced, own = [], {}
        for i, text in enumerate(texts):
            line = text.replace("\n", " \n")
            if not text:
                own[i] = []
            elif not self.by_word:
                own[i] = [MARK + text.replace(" ", MARK)]
            elif text[0] == " " or MARK in text or "  " in line:
                own[i] = RUNS.findall(MARK + text.replace(" ", MARK))
            spaced.append("" if i in own else line)
        split = pc.split_pattern(pa.array(spaced, pa.large_string()), " ")
        if not own:
            return split
        place = np.arange(len(texts))
        place[list(own)] = len(texts) + np.arange(len(own))
        return pa.concat_arrays([split, pa.array(own.values(), split.type)]).take(pa.array(place))

    def learn(self, words: list[str]) -> None:
        new = []
        for w in words:
            if w in self.old:
                self.known[w] = self.old[w]
            else:
                new.append(w)
        full = [w if w[:1] in (MARK, "\n") else MARK + w for w in new]
        # The library puts a mark before a text: it stands for the word's own, or comes as an id of its own before a line end.
        asked = self.library.encode([(w[1:] if w[0] == MARK else w).replace(MARK, " ") for w in full], num_threads=1)
        for word, spelled, theirs in zip(new, full, asked):
            own = self.agenda_ids(spelled)
            if spelled == MARK:
                theirs = own  # the library gives nothing for an empty text
            elif spelled[0] != MARK:
                theirs = theirs[1:]
            if own != theirs:
                self.changed.add(word)
                own = theirs
            self.known[word] = array("I", own).tobytes()

    def numbers(self, words: list[str]) -> list[bytes]:
        known = self.known
        if new := [w for w in words if w not in known]:
            self.learn(new)
        return list(map(known.__getitem__, words))

    def encode(self, texts: list[str]) -> list[tuple[list[int], str, bool]]:
        """Ids of each text with the end id behind them, the same as decimal text, and whether all are the agenda's."""
        lists = self.words(texts)
        flat, starts, at, words = laid_out(lists, self.numbers)
        ids = np.insert(flat, starts[1:], self.end)
        starts = starts + np.arange(len(starts))
        spelled = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(starts), pa.array(ids).cast(pa.string())), " ").to_pylist()
        own = np.ones(len(texts), bool)
        if self.changed:
            other = np.fromiter(map(self.changed.__contains__, words), bool, len(words))
            own = np.diff(np.concatenate([[0], np.cumsum(other[at])])[row_starts(lists)]) == 0
        if len(self.known) > self.limit:
            self.old = self.known if len(self.known) < 2 * self.limit else {}
            self.known = {}
            self.changed.intersection_update(self.old)
        ends = starts.tolist()
        return [(ids[a:b].tolist(), text, mine) for a, b, text, mine in zip(ends, ends[1:], spelled, own.tolist())]


def _coded(batches, path: str):
    model = piece_model(path)
    for b in batches:
        found, size, at = list(zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist())), 0, 0
        for end, (_, text) in enumerate(found, 1):
            size += len(text)
            if size > BATCH_CHARS or end == len(found):
                yield _batch(list(_rows(model, found[at:end])))
                size, at = 0, end


def _rows(model: PieceModel, found: list[tuple]):
    for (doc_id, text), (ids, spelled, own_ids) in zip(found, model.encode([t for _, t in found])):
        decoded = model.library.decode(ids)
        if decoded != text:
            own = model.library.encode(text, add_eos=True)
            if own != ids:
                ids, spelled, own_ids = own, " ".join(map(str, own)), False
                decoded = model.library.decode(ids)
        yield doc_id, len(ids), spelled, decoded, own_ids


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "n_tokens", "ids", "decoded", "by_agenda"])


def piece_coding(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids (decimal, joined by spaces, the end id last), decoded text and by_agenda of every whole text.

    Null texts count as empty and give the end id alone. Rows map one to one: repeated rows and null ids
    stay; an empty table gives an empty one.
    """
    return texts(docs).mapInArrow(functools.partial(_coded, path=model_path), "doc_id long, n_tokens long, ids string, decoded string, by_agenda boolean")


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    coded = piece_coding(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "by_agenda")
