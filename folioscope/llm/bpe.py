"""Byte-pair encoding and decoding by a pair occurrence index.

The new distinct pieces of a slice of a partition stand in one array of symbols. The index maps the rank of each adjacent
pair to all of its positions; ranks are applied in ascending order, each at all of its positions at once, and the
lists of the pairs that a merge makes are extended. A position whose pair has changed meanwhile is passed over
when its list comes up. Pieces already encoded in the task are looked up, so each distinct piece is merged once.

The vocabulary is a JSON file of the tokenizers library (BPE over byte letters, a Split pattern, an optional word end).
It is read on the driver and travels with the plan: its size is that of the file, whatever the data. The library's own
normalizer runs where a text is not plain ASCII, so that Unicode tables agree; merging and decoding are done here.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 4 << 20  # text whose pieces are indexed and handed on together; a longer text stands alone
CACHE_PIECES = 400_000  # pieces a task remembers; beyond that it starts anew


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 as itself, the others from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """What a tokenizer file says: ids of bytes, ranked pairs, special strings, the pattern of pieces, texts of ids."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        splits = [p for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", []) if p["type"] == "Split"]
        if model["type"] != "BPE" or len(splits) != 1 or spec["decoder"] is not None:
            raise ValueError("the file must hold BPE with one Split pattern and no decoder")
        vocab, self.source = model["vocab"], source
        end = model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + end] for c in letters]
        pairs = [p if isinstance(p, list) else p.split(" ", 1) for p in model["merges"]]
        left, right = (np.array([vocab[p[i]] for p in pairs], np.int64) for i in (0, 1))
        self.made = [vocab[a + b] for a, b in pairs]
        first_made: dict[int, int] = {}
        for rank, token in enumerate(self.made):
            first_made.setdefault(token, rank)
        if any(max(first_made.get(int(a), -1), first_made.get(int(b), -1)) >= rank for rank, (a, b) in enumerate(zip(left, right, strict=True))):
            raise ValueError("a pair ranks before the merge that makes its parts")
        self.size = max(vocab.values(), default=0) + 1
        self.parts = list(zip(left.tolist(), right.tolist(), strict=True))
        keys = left * self.size + right
        self.rank_of = {int(k): r for r, k in enumerate(keys)}
        order = np.argsort(keys)
        self.sorted_keys, self.sorted_ranks = keys[order], order
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.pattern = regex.compile(splits[0]["pattern"]["Regex"])
        self.tokens = {i: t.encode() for t, i in vocab.items()} | {i: t.encode() for t, i in self.special.items()}


class Pieces:
    """Texts to pieces. A text with characters that the two regular-expression libraries class differently is cut by the tokenizer's own."""

    def __init__(self, vocabulary: Vocabulary):
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        self.vocabulary = vocabulary
        self.normalizer = Tokenizer.from_str(vocabulary.source).normalizer
        steps = json.loads(vocabulary.source)["normalizer"] or {"type": "Sequence", "normalizers": []}
        kinds = [s["type"] for s in steps.get("normalizers", [steps])]
        self.only_lowers = kinds == ["NFC", "Replace", "Lowercase"] and steps["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
        self.split = pre_tokenizers.Split(Regex(vocabulary.pattern.pattern), "removed", invert=True)
        self.known: dict[str, bool] = {}

    def _agrees(self, char: str) -> bool:
        found = self.known.get(char)
        if found is None:
            probes = [char, "a" + char, "1" + char, "!" + char, "'s" + char]
            found = self.known[char] = all(
                [p for p, _ in self.split.pre_tokenize_str(x)] == self.vocabulary.pattern.findall(x) for x in probes)
        return found

    def of(self, text: str) -> list[str]:
        """The pieces of one text; special strings are pieces of their own, marked by a leading NUL."""
        if self.vocabulary.special_pattern is None:
            return self._plain(text)
        parts = self.vocabulary.special_pattern.split(text)
        if len(parts) == 1:
            return self._plain(text)
        out = []
        for i, part in enumerate(parts):
            out += ["\0" + part] if i % 2 else self._plain(part) if part else []
        return out

    def _plain(self, text: str) -> list[str]:
        if self.only_lowers and text.isascii():
            text = text.lower()  # no composition; white space stands in no piece
        elif self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        if all(self.known.get(c) or self._agrees(c) for c in set(text)):
            return self.vocabulary.pattern.findall(text)
        return [p for p, _ in self.split.pre_tokenize_str(text)]


def merge_pieces(pieces: list[bytes], vocabulary: Vocabulary) -> list[bytes]:
    """Packed token ids of every piece (non-empty, in bytes), by ascending ranks over all positions of all pieces."""
    if not pieces:
        return []
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    ends = np.cumsum(lengths)
    data = np.frombuffer(b"".join(pieces), np.uint8)
    start = np.array(vocabulary.inner, np.int64)[data]
    start[ends - 1] = np.array(vocabulary.last, np.int64)[data[ends - 1]]

    # the index: rank -> positions of the left symbol, ascending
    keys = start[:-1] * vocabulary.size + start[1:]
    keys[ends[:-1] - 1] = -1  # no pair crosses pieces
    at = np.searchsorted(vocabulary.sorted_keys, keys)
    at[at == len(vocabulary.sorted_keys)] = 0
    positions = np.flatnonzero(vocabulary.sorted_keys[at] == keys) if len(vocabulary.sorted_keys) else np.zeros(0, np.int64)
    ranks = vocabulary.sorted_ranks[at[positions]]
    order = np.argsort(ranks, kind="stable")
    positions, ranks = positions[order], ranks[order]
    cuts = np.flatnonzero(np.diff(ranks)) + 1
    index = {int(ranks[a]): positions[a:b].tolist() for a, b in zip([0, *cuts], [*cuts, len(ranks)], strict=True) if b > a}

    symbol = start.tolist()
    after = list(range(1, len(symbol) + 1))
    before = list(range(-1, len(symbol) - 1))
    for e in ends.tolist():
        after[e - 1] = -1
        if e < len(symbol):
            before[e] = -1
    rank_of, made, parts, size = vocabulary.rank_of, vocabulary.made, vocabulary.parts, vocabulary.size
    active = list(index)
    heapq.heapify(active)
    while active:
        rank = heapq.heappop(active)
        token, (left, right) = made[rank], parts[rank]
        positions = index.pop(rank)
        for i in sorted(positions) if left == right else positions:  # only a pair of equal symbols can overlap itself
            j = after[i]
            if symbol[i] != left or j < 0 or symbol[j] != right:
                continue  # an earlier merge took part of the pair
            symbol[i], symbol[j] = token, -1
            k = after[i] = after[j]
            after[j] = -1
            touched = [(before[i], i)]
            if k >= 0:
                before[k] = i
                touched.append((i, k))
            for a, b in touched:
                if a >= 0:
                    new = rank_of.get(symbol[a] * size + symbol[b])
                    if new is not None:
                        if new in index:
                            index[new].append(a)
                        else:
                            index[new] = [a]
                            heapq.heappush(active, new)
    symbols = np.array(symbol, np.int64)
    alive = symbols >= 0
    kept = np.concatenate([[0], np.cumsum(alive)])[np.concatenate([[0], ends])]
    flat, cuts = symbols[alive].astype("<u4").tobytes(), (kept * 4).tolist()
    return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


class Encoder:
    """Texts to packed ids, with the pieces a task has met."""

    def __init__(self, source: str):
        self.vocabulary = Vocabulary(source)
        self.pieces = Pieces(self.vocabulary)
        self.packed: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        cut = [self.pieces.of(t) if t else [] for t in texts]
        if len(self.packed) > CACHE_PIECES:
            self.packed = {}
        new = [p for p in set().union(*cut) if p not in self.packed]
        plain = [p for p in new if p[0] != "\0" or p[1:] not in self.vocabulary.special]
        self.packed.update(zip(plain, merge_pieces([p.encode() for p in plain], self.vocabulary), strict=True))
        for p in new:
            if p not in self.packed:
                self.packed[p] = np.array([self.vocabulary.special[p[1:]]], "<u4").tobytes()
        look = self.packed.__getitem__
        return [b"".join(map(look, pieces)) for pieces in cut]


def _slices(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    ends, first = np.cumsum(sizes), 0
    while first < len(sizes):
        low = ends[first] - sizes[first]
        last = max(int(np.searchsorted(ends, low + limit, "right")), first + 1)
        yield first, last
        first = last


def _mapped(df: DataFrame, column: str, result: str, kind: T.DataType, arrow: pa.DataType, make) -> DataFrame:
    """``df`` with ``result`` made from ``column``; a column of that name, in any case, is replaced."""
    keep = [c for c in df.columns if c.lower() != result.lower()]
    inputs = df.select(*[F.col(f"`{c}`") for c in keep]) if column in keep else df
    schema = T.StructType([*df.select(*[F.col(f"`{c}`") for c in keep]).schema.fields, T.StructField(result, kind)])

    def work(batches):
        convert = make()
        for batch in batches:
            values = batch.column(batch.schema.get_field_index(column))
            sizes = np.asarray(values.cast(pa.large_binary() if pa.types.is_binary(values.type) else pa.large_string()).is_valid(), np.int64)
            lengths = pa.compute.fill_null(pa.compute.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for first, last in _slices(lengths + sizes, SLICE_BYTES):
                part = batch.slice(first, last - first)
                rest = [part.column(part.schema.get_field_index(c)) for c in keep]
                made = convert(values.slice(first, last - first).to_pylist())
                yield pa.RecordBatch.from_arrays([*rest, pa.array(made, arrow)], [*keep, result])

    return inputs.mapInArrow(work, schema)


def encode(docs: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with ``ids``: the token ids of the whole text as packed little-endian unsigned 32-bit integers.

    ``tokenizer`` is the path of the vocabulary file on the driver. Special strings of the file standing in a text are
    their own ids, none are added. A null or empty text has no ids (an empty value). Rows keep their other columns,
    repeated rows stay repeated, an empty table gives an empty one; a column already named ``ids`` is replaced.
    """
    source = Path(tokenizer).read_text(encoding="utf-8")
    return _mapped(docs, text, ids, T.BinaryType(), pa.binary(), lambda: Encoder(source).encode)


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with ``text``: the tokens of packed ``ids`` joined by blanks, special ones included.

    Null or empty ids give an empty text; an id that the file does not have is left out.
    """
    source = Path(tokenizer).read_text(encoding="utf-8")

    def make():
        tokens = Vocabulary(source).tokens

        def convert(packed: list[bytes | None]) -> list[str]:
            return [b" ".join([tokens[i] for i in np.frombuffer(p or b"", "<u4").tolist() if i in tokens]).decode() for p in packed]

        return convert

    return _mapped(df, ids, text, T.StringType(), pa.string(), make)
