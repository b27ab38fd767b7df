"""Best-fit packing of token sequences by minimum bin slack.

Documents become token ids (then one end id); only those over the capacity are cut. Pieces are dealt at random into groups of
a bounded expected size, and each group is packed by itself: a sequence is opened with the longest piece left, and a subset-sum
over the lengths still available, held as a bitset of reachable sums, finds the fullest combination that fits beside it.
A group wastes room only in its last sequences, so the loss is a fraction of a sequence in thousands.

Null text is empty: its one piece is the end id. Repeated rows and rows without an id are packed like any other. An empty
table gives no piece.
"""

from __future__ import annotations

import itertools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.base import byte_hashes, covered, id_and_text, read
from tidewire.session import cut_lineage

CAPACITY, END_ID = 4096, 1
#: Pieces of a group: packing holds one group's lengths in a task.
GROUP = 16_384
#: Parts of words whose ids a worker remembers before it forgets those not used since the last time, and the most ids one keeps then.
REMEMBERED, LONGEST = 1_000_000, 48
SEPARATOR, SEPARATOR_ID = "<|startoftext|>", 49406
# Kinds of bytes: blanks, and in words letters, digits, signs and all others. Lower-case ASCII and Latin letters are those whose UTF-8
# bytes the byte alphabet leaves as they are; a quote may start a contraction.
BLANK, LETTER, DIGIT, SIGN, OTHER = range(5)
_KIND = np.full(256, OTHER, dtype=np.uint8)
_KIND[33:127], _KIND[ord("'")], _KIND[ord("A") : ord("Z") + 1] = SIGN, OTHER, OTHER
_KIND[ord(" ")], _KIND[ord("0") : ord("9") + 1], _KIND[ord("a") : ord("z") + 1] = BLANK, DIGIT, LETTER
_ACCENT = np.zeros(256, dtype=bool)  # what may follow the byte C3
_ACCENT[[*range(0xA1, 0xAD), *range(0xAE, 0xB7), *range(0xB8, 0xC0)]] = True
_STOP = np.isin(np.arange(256), list(b".,"))
_BEFORE_STOP = np.isin(np.arange(256), list(b"abcdefghijklmnopqrstuvwxyz0123456789"))


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def parts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the parts of the words of lowered bytes that end in a blank, and whether a part is simple.

    A full stop or comma after a word is a word of its own. Simple words are of letters, digits and signs alone, and fall into runs of
    letters or signs and single digits; other words are one part.
    """
    kind = _KIND[data]
    accent = np.flatnonzero(data[:-1] == 0xC3)
    accent = accent[_ACCENT[data[accent + 1]]]
    kind[accent] = kind[accent + 1] = LETTER
    word = kind != BLANK
    stop = np.flatnonzero(_STOP[data])
    stop = stop[(stop > 0) & ~word[np.minimum(stop + 1, len(data) - 1)]]
    stop = stop[_BEFORE_STOP[data[stop - 1]]]
    first = word.copy()
    first[1:] &= ~word[:-1]
    first[stop] = True
    starts = np.flatnonzero(first)
    other = np.unique(np.searchsorted(starts, np.flatnonzero(kind == OTHER), side="right")) - 1
    if len(other):
        ends = np.append(starts[1:], len(data))
        whole = covered(starts[other], ends[other], len(data)) & word
        kind[whole] = OTHER
    first[1:] |= word[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT))
    starts = np.flatnonzero(first)
    last = word
    last[:-1] &= first[1:] | ~word[1:]
    return starts, np.flatnonzero(last) + 1, kind[starts] != OTHER


class WordTokenizer:
    """Ids of whole texts by a tokenizer that lowers letters, splits words from signs and never joins across a blank.

    So A-Z may be lowered first, a line end be a blank, a full stop or comma after a word stand apart, and a word of which nothing is
    normalised be taken apart by kinds. The parts of many texts are found together and looked up by 64 bits of hash; simple ones go
    straight to the tokenizer's model the first time. Texts with what could be a special token are left as they are.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; threads of its own would only add memory
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.model = self.tokenizer.model
        # sorted names of the parts known, where their ids start in the pool, how many they are, and whether they were used lately
        self.known, self.at = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int32)
        self.size, self.used = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=bool)
        self.pool = np.zeros(0, dtype="<u4")

    def by_model(self, words: list[bytes]) -> list[list[int]]:
        """The ids of simple parts, each byte a letter of the byte alphabet."""
        tokens = self.model.tokenize
        return [[t.id for t in tokens(word.decode("latin-1"))] for word in words]

    def by_tokenizer(self, words: list[bytes]) -> list[list[int]]:
        """The ids of any words, in few calls; what holds a special token apart."""
        out: list[list[int]] = [[]] * len(words)
        plain = [n for n, word in enumerate(words) if b"<|" not in word]
        blocks = [plain[i : i + 500] for i in range(0, len(plain), 500)]
        joined = [SEPARATOR.join([words[n].decode() for n in b]) for b in blocks]
        for block, encoded in zip(blocks, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
            ids = np.array(encoded.ids, dtype="<u4")
            cuts = np.flatnonzero(ids == SEPARATOR_ID)
            for n, a, b in zip(block, [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)]):
                out[n] = ids[a:b].tolist()
        for n, word in enumerate(words):
            if b"<|" in word:
                out[n] = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
        return out

    def learn(self, names: np.ndarray, words: list[bytes], simple: np.ndarray) -> None:
        """Remember the ids of new parts, whose names are sorted."""
        found: list[list[int]] = [[]] * len(words)
        for these, ids in ((np.flatnonzero(simple), self.by_model), (np.flatnonzero(~simple), self.by_tokenizer)):
            for n, x in zip(these.tolist(), ids([words[n] for n in these.tolist()])):
                found[n] = x
        size = np.array([len(x) for x in found], dtype=np.int32)
        at = (len(self.pool) + np.cumsum(size) - size).astype(np.int32)
        self.pool = np.concatenate((self.pool, np.fromiter(itertools.chain.from_iterable(found), dtype="<u4", count=int(size.sum()))))
        place = np.searchsorted(self.known, names)
        self.known, self.at, self.size = (np.insert(old, place, new) for old, new in ((self.known, names), (self.at, at), (self.size, size)))
        self.used = np.insert(self.used, place, True)

    def forget(self) -> None:
        """Keep the parts used since the last time, unless they have very many ids."""
        kept = self.used & (self.size <= LONGEST)
        self.known, at, self.size = (x[kept] for x in (self.known, self.at, self.size))
        self.pool = self.pool[places(at, self.size)]
        self.at = (np.cumsum(self.size) - self.size).astype(np.int32)
        self.used = np.zeros(len(self.known), dtype=bool)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian numbers."""
        raw = [t.encode("utf-8", "replace").replace(b"\n", b" ") for t in texts]
        special = {n: self.by_tokenizer(x.split(b" ")) for n, x in enumerate(raw) if b"<|" in x}
        joined = b" ".join([*(b"" if n in special else x for n, x in enumerate(raw)), b""]).lower()
        data = np.frombuffer(joined, dtype=np.uint8)
        starts, ends, simple = parts(data) if len(data) else (np.zeros(0, dtype=np.int64),) * 3
        size, ids = np.zeros(0, dtype=np.int64), self.pool[:0]
        if len(starts):
            which, names = pd.factorize(byte_hashes(data).spans(starts, ends))
            sample = np.empty(len(names), dtype=np.int64)
            sample[which[::-1]] = np.arange(len(which))[::-1]
            order = np.argsort(names)
            known = np.searchsorted(self.known, names[order])
            fresh = np.ones(len(order), dtype=bool) if not len(self.known) else self.known[np.minimum(known, len(self.known) - 1)] != names[order]
            if fresh.any():
                new = sample[order[fresh]]
                self.learn(names[order[fresh]], [joined[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())], simple[new].astype(bool))
                known += np.cumsum(fresh) - fresh
            self.used[known] = True
            place = np.empty(len(order), dtype=np.int64)
            place[order] = known
            size = self.size[place][which]
            ids = self.pool[places(self.at[place][which], size)]
        if np.count_nonzero(self.used) > REMEMBERED or len(self.pool) > 8 * REMEMBERED:
            self.forget()
        # where the ids of each text start
        lengths = np.array([1 + (0 if n in special else len(x)) for n, x in enumerate(raw)], dtype=np.int64)
        cuts = np.append(0, np.cumsum(size, dtype=np.int64))[np.searchsorted(starts, np.append(0, np.cumsum(lengths)))].tolist()
        out = [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
        for n, found in special.items():
            out[n] = np.array([i for x in found for i in x], dtype="<u4").tobytes()
        return out


def places(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of pieces that start somewhere and have some size, one piece after the other."""
    size = size.astype(np.int64)
    ends = np.cumsum(size)
    return np.repeat(at - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


_tokenizers: dict[str, WordTokenizer] = {}


def piece_rows(vocabulary: str, capacity: int, end_id: int, batch_chars: int = 1_000_000):
    end = int(end_id).to_bytes(4, "little")

    def pieces(ids: list[int | None], texts: list[str], tokenizer: WordTokenizer) -> Iterator[tuple]:
        for doc_id, data in zip(ids, tokenizer.encode(texts)):
            data += end
            for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                part = data[at : at + 4 * capacity]
                yield doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if vocabulary not in _tokenizers:
            _tokenizers[vocabulary] = WordTokenizer(vocabulary)
        for batch in batches:
            texts = batch["text"].fillna("")
            blocks = texts.str.len().cumsum() // batch_chars
            for _, block in batch.assign(text=texts).groupby(blocks):
                out = list(pieces(block["doc_id"].tolist(), block["text"].tolist(), _tokenizers[vocabulary]))
                yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype({"doc_id": "Int64"})

    return rows


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece of every document."""
    return id_and_text(docs, id_col, text_col).mapInPandas(
        piece_rows(vocabulary, capacity, end_id), "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def fullest(available: list[tuple[int, int]], room: int) -> list[int]:
    """The lengths, each at most as often as available, with the greatest sum that fits the room.

    available holds (length, count), longest first. Bit s of a bitset says that the sum s can be reached; counts are split
    into powers of two. The bitsets before each step lead back from the best sum to the lengths that make it.
    """
    within, reach = (1 << (room + 1)) - 1, 1
    steps: list[tuple[int, int, int]] = []
    for length, count in available:
        if length > room:
            continue
        left, part = min(count, room // length), 1
        while left and not reach >> room:
            take = min(part, left)
            steps.append((reach, length, take))
            reach |= (reach << (length * take)) & within
            left -= take
            part *= 2
        if reach >> room:
            break
    best, chosen = reach.bit_length() - 1, []
    for before, length, take in reversed(steps):
        if not before >> best & 1:
            chosen += [length] * take
            best -= length * take
    return chosen


def minimum_slack(lengths: list[int], capacity: int) -> list[list[int]]:
    """Indexes of the given lengths, bin by bin."""
    waiting: dict[int, list[int]] = {}
    for i, length in enumerate(lengths):
        waiting.setdefault(length, []).append(i)
    order = sorted(waiting, reverse=True)
    bins = []
    while order:
        longest = order[0]
        taken = [waiting[longest].pop()]
        for length in fullest([(x, len(waiting[x])) for x in order if x <= capacity - longest and waiting[x]], capacity - longest):
            taken.append(waiting[length].pop())
        if any(not waiting[lengths[i]] for i in taken):
            order = [x for x in order if waiting[x]]
        bins.append(taken)
    return bins


def packed_rows(capacity: int):
    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("row", ignore_index=True)
        sequence = np.empty(len(group), dtype=np.int64)
        offset = np.empty(len(group), dtype=np.int64)
        lengths = group["length"].tolist()
        for number, members in enumerate(minimum_slack(lengths, capacity)):
            sequence[members] = (int(key[0]) << 32) + number
            offset[members] = np.cumsum([0, *(lengths[i] for i in members[:-1])])
        return group.drop(columns=["group", "row"]).assign(sequence_id=sequence, offset=offset)

    return pack


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_size: int = GROUP) -> DataFrame:
    """pieces (with a length of at most the capacity) with their sequence_id and the offset in it."""
    stored = cut_lineage(pieces.withColumn("row", F.monotonically_increasing_id()))
    groups = max(1, -(-stored.count() // group_size))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return (
        stored.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
        .groupBy("group")
        .applyInPandas(packed_rows(capacity), f"{fields}, sequence_id long, offset long")
    )


def op6_packing(spark: SparkSession, folder: str, vocabulary: str | None = None) -> DataFrame:
    return pack(token_pieces(read(spark, folder, "documents"), vocabulary or default_vocabulary()))
