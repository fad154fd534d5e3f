"""SentencePiece encoding and decoding by vectorised merge rounds.

The model is a byte-fallback BPE vocabulary. A text is cut where no piece can reach across: before a space mark that
follows another character, and around characters that no piece holds. Each distinct part is encoded once per task:
all new parts of a batch lie in one flat array of symbols, and in every round each part finds the lowest rank among
its adjacent pairs (a segmented minimum) and merges it, from the left, all parts at the same time; then the arrays
are compacted. A round merges all occurrences of a part's best pair where no pair that the merged piece forms can
rank before it, and the leftmost one otherwise, so the order is that of one-by-one merging. Parts without a pair
leave the arrays, and the rounds end when none is left.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from padron.llm.common import portions, texts

MARK = "▁"
#: New parts after which a task forgets those not met lately. It only saves work: a forgotten part is encoded again.
REMEMBERED = 100_000
#: Characters of texts whose parts are held at once.
GROUP = 500_000
_NO_RANK = np.iinfo(np.int64).max
_PLACE_BITS = 19


class Part(NamedTuple):
    """What a part of a text encodes to: ids, the ids as decimal text, and the text they decode to inside a text."""

    ids: tuple[int, ...]
    spelled: bytes
    text: str


class Vocabulary:
    """Pieces of a model file, the pairs that merge, and the encodings of the parts met so far."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.end = model.eos_id()
        control = {i for i in range(n) if model.is_control(i) or model.is_unknown(i)}
        bytes_ = {i for i in range(n) if model.is_byte(i)}
        self.normal = {self.pieces[i]: i for i in range(n) if i not in control and i not in bytes_}
        self.byte_ids = [self._id_of(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        self.control = control
        self.plain = [None if i in control or i in self.byte_of else p for i, p in enumerate(self.pieces)]
        rank = self._ranks(np.array([model.get_score(i) for i in range(n)]))
        self._pairs(rank)
        held = set("".join(self.normal)) - {MARK}
        inner = re.escape("".join(sorted(held)))
        #: Space marks with the held characters behind them, or one character that no piece holds.
        self.part = re.compile(f"{MARK}*[{inner}]+|{MARK}+|[^{inner}{MARK}]", re.S)
        self.spelled = [b"%d" % i for i in range(n)]
        self.known: dict[str, Part] = {}
        self.earlier: dict[str, Part] = {}

    def _id_of(self, piece: str) -> int:
        return self.pieces.index(piece)

    @staticmethod
    def _ranks(score: np.ndarray) -> np.ndarray:
        """Equal for equal scores, lower for better ones."""
        return np.unique(-score, return_inverse=True)[1].astype(np.int64)

    def _pairs(self, rank: np.ndarray) -> None:
        """All pairs of symbols that merge into a piece. Symbols are pieces, and characters that are no piece."""
        symbols = dict(self.normal)
        for char in sorted(set("".join(self.normal))):
            symbols.setdefault(char, len(self.pieces) + len(symbols))
        self.symbol = {c: i for c, i in symbols.items() if len(c) == 1}
        found = [
            (symbols[p[:at]], symbols[p[at:]], i)
            for p, i in self.normal.items()
            for at in range(1, len(p))
            if p[:at] in symbols and p[at:] in symbols
        ]
        left, right, made = (np.array(x, dtype=np.int64) for x in zip(*found, strict=True))
        self.keys = (left << 32) | right
        self.made = made
        self._table()
        self.rank = rank[self.made]
        # A merge is safe if no pair that its piece is part of ranks before it or level with it.
        best = np.full(len(self.pieces) + len(symbols) + 1, _NO_RANK)
        np.minimum.at(best, left, rank[made])
        np.minimum.at(best, right, rank[made])
        self.safe = best[self.made] > self.rank

    def _table(self) -> None:
        """Places of the keys by hash. Where keys share a place, the later ones go to the next table."""
        self.tables, left = [], np.arange(len(self.keys))
        while len(left):
            table = np.zeros(1 << _PLACE_BITS, np.int32)
            place = self._place(self.keys[left])
            table[place[::-1]] = left[::-1] + 1
            self.tables.append(table)
            left = left[table[place] != left + 1]

    @staticmethod
    def _place(keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _PLACE_BITS)

    # ---- encoding -----------------------------------------------------------------------------------------------

    def split(self, text: str) -> list[str]:
        """The parts of a text, spaces written as marks and one mark put in front."""
        return self.part.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, text: str) -> list[int]:
        parts = self.split(text)
        self.learn(set(parts))
        return [i for p in parts for i in self.known[p].ids]

    def learn(self, parts: set[str]) -> None:
        """Encodes the parts that aren't known yet; afterwards ``known`` has all of them."""
        if len(self.known) > REMEMBERED:
            self.known, self.earlier = {}, self.known
        new, found = [], {}
        for p in parts.difference(self.known):
            if (old := self.earlier.get(p)) is not None:
                self.known[p] = old
            elif len(p) == 1:
                found[p] = self._single(p)
            else:
                new.append(p)
        found.update(zip(new, self._merge(new), strict=True))
        spelled, before = self.spelled, self.normal["a"]  # a piece in front keeps decode() from taking off the part's own first space
        for p, ids in found.items():
            self.known[p] = Part(ids, b" ".join([spelled[i] for i in ids]), self.decode((before, *ids))[1:])

    def _single(self, char: str) -> tuple[int, ...]:
        if char in self.normal:
            return (self.normal[char],)
        return tuple(self.byte_ids[b] for b in char.encode("utf-8", "replace"))

    def _merge(self, parts: list[str]) -> list[tuple[int, ...]]:
        if not parts:
            return []
        joined = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
        distinct, inverse = np.unique(joined, return_inverse=True)
        symbols = np.array([self.symbol[chr(c)] for c in distinct], dtype=np.int64)[inverse]
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        done_symbols, done_owner = [], []
        while len(symbols):
            rank, made, safe = self._look_up(symbols, owner)
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, len(owner)])
            best = np.minimum.reduceat(rank, starts)
            live = np.repeat(best != _NO_RANK, sizes)
            if not live.all():
                done_symbols.append(symbols[~live])
                done_owner.append(owner[~live])
                symbols, owner, rank, made, safe = (x[live] for x in (symbols, owner, rank, made, safe))
                sizes, best = sizes[best != _NO_RANK], best[best != _NO_RANK]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(best, sizes))
            at = self._chosen(at, symbols, owner, safe)
            symbols[at] = made[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        flat, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        spelled = tuple if flat.max() < len(self.pieces) else self._spelled
        ids, ends = flat[order].tolist(), np.cumsum(np.bincount(owner, minlength=len(parts))).tolist()
        out, at = [], 0
        for end in ends:
            out.append(spelled(ids[at:end]))
            at = end
        return out

    def _look_up(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rank, piece and safety of the pair that each symbol forms with the next one of its part."""
        rank = np.full(len(symbols), _NO_RANK)
        made = np.zeros(len(symbols), np.int64)
        safe = np.zeros(len(symbols), bool)
        at = np.flatnonzero(owner[:-1] == owner[1:])
        key = (symbols[at] << 32) | symbols[at + 1]
        place = self._place(key)
        for table in self.tables:
            entry = table[place]
            hit = np.flatnonzero(entry)
            hit = hit[self.keys[entry[hit] - 1] == key[hit]]
            pair = entry[hit] - 1
            rank[at[hit]], made[at[hit]], safe[at[hit]] = self.rank[pair], self.made[pair], self.safe[pair]
        return rank, made, safe

    @staticmethod
    def _chosen(at: np.ndarray, symbols: np.ndarray, owner: np.ndarray, safe: np.ndarray) -> np.ndarray:
        """Of the best pairs' places: the leftmost of each part, and all like it that don't overlap if it is safe."""
        first = np.r_[True, owner[at[1:]] != owner[at[:-1]]]
        lead = at[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
        alike = (symbols[at] == symbols[lead]) & (symbols[at + 1] == symbols[lead + 1])
        at = at[first | (alike & safe[lead])]
        # In a chain of overlapping places, every other one counts from the left.
        chain = np.r_[True, (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])]
        begin = np.maximum.accumulate(np.where(chain, np.arange(len(at)), 0))
        return at[(np.arange(len(at)) - begin) % 2 == 0]

    def _spelled(self, symbols: list[int]) -> tuple[int, ...]:
        """Ids of symbols; characters that are no piece become bytes."""
        char = {i: c for c, i in self.symbol.items() if i >= len(self.pieces)}
        return tuple(i for s in symbols for i in ((s,) if s < len(self.pieces) else self._single(char[s])))

    # ---- decoding -----------------------------------------------------------------------------------------------

    def decode(self, ids: list[int] | tuple[int, ...]) -> str:
        """The text of ids: pieces with marks as spaces, runs of byte pieces as UTF-8, without the first space."""
        try:
            whole = "".join([self.plain[i] for i in ids])
        except TypeError:  # bytes or control ids among them
            pass
        else:
            return (whole[1:] if whole[:1] == MARK else whole).replace(MARK, " ")
        out, raw, first = [], bytearray(), True

        def flush() -> None:
            if raw:
                out.append(_utf8(bytes(raw)))
                raw.clear()

        for i in ids:
            if i in self.control:
                continue
            if (b := self.byte_of.get(i)) is not None:
                raw.append(b)
                first = False
                continue
            flush()
            piece = self.pieces[i]
            out.append(piece[1:] if first and piece.startswith(MARK) else piece)
            first = False
        flush()
        return "".join(out).replace(MARK, " ")


def _utf8(raw: bytes) -> str:
    """Bytes as text; every byte that is not part of a character becomes one replacement character."""
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            for size in (1, 2, 3, 4):
                try:
                    out.append(raw[at : at + size].decode("utf-8"))
                    at += size
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One per Python worker."""
    return Vocabulary(path)


def encode(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, ids, decoded``: the ids of every text with an end id, and the text they decode to.

    ``model`` is a path that every executor has. A null text counts as empty: one id, the end, and an empty text.
    Nothing else is read of the row; repeated rows and null ids stay. An empty table gives an empty one.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, words, parts in _encoded(batches, vocabulary(model)):
            lists = [[i for p in own for i in words.known[p].ids] + [words.end] for own in parts]
            plain = [_plain(words, own) for own in parts]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([len(x) for x in lists], pa.int64()), pa.array(lists, pa.list_(pa.int32())),
                 pa.array(plain, pa.string())],
                names=[id_col, "n_tokens", "ids", "decoded"],
            )

    return docs.select(id_col, text_col).mapInArrow(work, f"`{id_col}` {kind}, n_tokens bigint, ids array<int>, decoded string")


def digests(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256``: as :func:`encode`, with the two results as digests.

    Hashes are fed part by part, so ids and decoded texts are never held for a whole batch.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, words, parts in _encoded(batches, vocabulary(model)):
            known, end = words.known, b"%d" % words.end
            count, of_ids, of_text = [], [], []
            for own in parts:
                found = [known[p] for p in own]
                spelled = b" ".join([*(p.spelled for p in found), end])
                count.append(spelled.count(b" ") + 1)
                of_ids.append(hashlib.sha256(spelled).hexdigest())
                of_text.append(hashlib.sha256(_plain(words, own).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(count, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select(id_col, text_col).mapInArrow(work, schema)


def _plain(words: Vocabulary, parts: list[str]) -> str:
    """The decoded text. Parts decode one by one, as none ends within a character's bytes; its first space goes."""
    text = "".join([words.known[p].text for p in parts])
    return text[1:] if text[:1] == " " else text


def _encoded(batches: Iterator[pa.RecordBatch], words: Vocabulary) -> Iterator[tuple[pa.Array, Vocabulary, list[list[str]]]]:
    """Groups of rows of half a MB: their ids, the vocabulary that knows all their parts, and the parts of each text."""
    for batch in (part for whole in batches for part in portions(whole, 1, GROUP)):
        parts = [words.split(t) for t in texts(batch.column(1))]
        words.learn(set().union(*parts))
        yield batch.column(0), words, parts
    # The worker may go on to other work; what its next task of this kind needs is learned again.
    words.known, words.earlier = {}, {}


def path_of(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
