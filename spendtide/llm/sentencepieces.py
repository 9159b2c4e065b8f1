"""SentencePiece encoding and decoding by a batched numpy Viterbi.

A text becomes the pieces of a model whose scores sum highest. A blank is written as the
piece mark, a text starts with one, and a character without a piece becomes its UTF-8
bytes. Decoding turns pieces back into bytes and takes the leading blank away, so every
text comes back as it was (but for the mark U+2581 itself, which reads as a blank, as in
the library).

Texts are cut where no piece can reach across: a mark follows another character in no
piece, some control signs are in none, and in long words two neighbouring characters may
be in none. What is left is segmented once per slice of documents and reused. Pieces of
equal length in characters advance together: all substrings of one length are hashed at
once and looked up in that length's sorted piece keys, with the characters compared after
a hit; then every end place takes the best of its substrings over all rows at once and
stores a backpointer. Of equal sums the longer last piece wins, as in the library. A very
long word that cannot be cut advances alone, in blocks.

The scores are the model's own and the result is the best path of the library's unigram
lattice for them. A model of type BPE, as the public 32k one, was made for merges in order
of the same scores; its own encoder cuts many words otherwise (figures in the README).

The model file is read on the driver, from a path that is a parameter; tasks get its
pieces as one broadcast variable, bounded by the vocabulary.

Defined results: a null text counts as an empty one, which has no pieces; null and
repeated ids keep a row each; an empty table gives an empty result; columns other than
those asked for are never read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendtide.llm.texts import map_texts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK, _UNKNOWN_PENALTY = "▁", 10.0
_BASE, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_FILTER_BITS, _LONG = 20, 32
#: Characters of a unit from which on it advances alone, and of its blocks.
_ALONE = 1 << 14


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


@dataclass
class Pieces:
    """A model's pieces: text, score and kind (0 normal, 1 byte, 2 other) by number."""

    texts: list[str]
    scores: np.ndarray
    kinds: np.ndarray

    @classmethod
    def load(cls, path: str = MODEL) -> "Pieces":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        kinds = [
            1 if model.is_byte(i) else 2
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else 0
            for i in ids
        ]
        scores = np.array([model.get_score(i) for i in ids], np.float64)
        return cls([model.id_to_piece(i) for i in ids], scores, np.array(kinds, np.int8))

    @cached_property
    def by_length(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each length: sorted keys, numbers of the pieces, their characters."""
        lengths: dict[int, list[int]] = {}
        for i in np.flatnonzero(self.kinds == 0):
            lengths.setdefault(len(self.texts[i]), []).append(int(i))
        found = {}
        for length, ids in sorted(lengths.items()):
            if length:
                chars = np.stack([_codes(self.texts[i]) for i in ids])
                keys = np.zeros(len(ids), np.uint64)
                for k in range(length):
                    keys = keys * _BASE + chars[:, k] + np.uint64(1)
                order = np.argsort(keys)
                if len(np.unique(keys)) < len(keys):
                    raise ValueError(f"two pieces of length {length} have the same key")
                found[length] = (keys[order], np.array(ids, np.int64)[order], chars[order])
        return found

    @cached_property
    def filters(self) -> dict[int, np.ndarray]:
        """For each length, which leading bits a piece's key can have."""
        found = {}
        for length, (keys, _, _) in self.by_length.items():
            found[length] = np.zeros(1 << _FILTER_BITS, bool)
            found[length][_leading(keys)] = True
        return found

    @cached_property
    def pairs(self) -> np.ndarray:
        """Neighbouring characters inside a piece, sorted."""
        inside = [
            (chars[:, k].astype(np.int64) << 21) | chars[:, k + 1]
            for _, _, chars in self.by_length.values() for k in range(chars.shape[1] - 1)
        ]
        return np.unique(np.concatenate(inside)) if inside else np.empty(0, np.int64)

    @cached_property
    def splitter(self) -> re.Pattern:
        """Marks and what follows them, but control signs that are in no piece alone."""
        used = {c for t, k in zip(self.texts, self.kinds) if k == 0 for c in t}
        alone = "".join(re.escape(chr(c)) for c in range(32) if chr(c) not in used)
        if any(re.search(f"[^{MARK}]{MARK}", t) for t, k in zip(self.texts, self.kinds) if k == 0):
            return re.compile("(?s).+")  # a piece reaches across words: one word each text
        return re.compile(f"{MARK}*[^{MARK}{alone}]+|[{alone}]|{MARK}+" if alone
                          else f"{MARK}*[^{MARK}]+|{MARK}+")

    @cached_property
    def byte_ids(self) -> np.ndarray:
        """The piece of each byte; the unknown piece where the model has none."""
        found = np.zeros(256, np.int64)
        for i in np.flatnonzero(self.kinds == 1):
            found[int(self.texts[i][1:-1], 16)] = i
        return found

    @cached_property
    def surfaces(self) -> list[bytes]:
        """What each piece decodes to."""
        return [
            bytes([int(t[1:-1], 16)]) if k == 1
            else b"" if k == 2 else t.replace(MARK, " ").encode()
            for t, k in zip(self.texts, self.kinds)
        ]

    @cached_property
    def unknown_score(self) -> float:
        return float(self.scores[self.kinds == 0].min()) - _UNKNOWN_PENALTY


def _leading(keys: np.ndarray) -> np.ndarray:
    return ((keys * _SPREAD) >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)


def viterbi(pieces: Pieces, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, how many) of the best pieces of each row of ``chars``, equally long words.

    A number below zero is an unknown character: minus its code, minus 1. Numbers stand
    at the end of a row.
    """
    rows, size = chars.shape
    best = np.full((size + 1, rows), -np.inf)
    best[0] = 0
    step, number = np.zeros((size + 1, rows), np.int16), np.zeros((size + 1, rows), np.int64)
    wide = np.ascontiguousarray(chars.T).astype(np.uint64)
    scores: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    key = np.zeros((size, rows), np.uint64)
    for length in range(1, min(size, max(pieces.by_length)) + 1):
        starts = size - length + 1
        key = key[:starts] * _BASE + wide[length - 1 :] + np.uint64(1)
        if length not in pieces.by_length:
            continue
        keys, ids, texts = pieces.by_length[length]
        maybe = np.flatnonzero(pieces.filters[length][_leading(key.ravel())])
        probe = key.ravel()[maybe]
        place = np.minimum(np.searchsorted(keys, probe), len(keys) - 1)
        hit = keys[place] == probe
        maybe, place = maybe[hit], place[hit]
        for k in range(length):  # a key may be another text's by chance
            same = wide[maybe // rows + k, maybe % rows] == texts[place, k]
            if not same.all():
                maybe, place = maybe[same], place[same]
        value, which = np.full(starts * rows, -np.inf), np.zeros(starts * rows, np.int64)
        value[maybe], which[maybe] = pieces.scores[ids[place]], ids[place]
        scores[length] = value.reshape(starts, rows), which.reshape(starts, rows)
    if 1 not in scores:
        scores[1] = np.full((size, rows), -np.inf), np.zeros((size, rows), np.int64)
    value, which = scores[1]
    unknown = np.isinf(value)
    value[unknown] = pieces.unknown_score
    which[unknown] = -1 - wide[unknown].astype(np.int64)
    for end in range(1, size + 1):
        for length in sorted((n for n in scores if n <= end), reverse=True):
            value, which = scores[length]
            offered = best[end - length] + value[end - length]
            better = offered > best[end]
            np.copyto(best[end], offered, where=better)
            np.copyto(number[end], which[end - length], where=better)
            np.copyto(step[end], length, where=better)
    found = np.zeros((rows, size), np.int64)
    many, at, every = np.zeros(rows, np.int64), np.full(rows, size), np.arange(rows)
    while (live := at > 0).any():
        on = every[live]
        many[on] += 1
        found[on, size - many[on]] = number[at[on], on]
        at[on] -= step[at[on], on]
    return found, many


def viterbi_alone(pieces: Pieces, codes: np.ndarray) -> np.ndarray:
    """The numbers of the best pieces of one long unit; unknown characters as above.

    Substrings are looked up in blocks of end places, which see as many characters before
    them as the longest piece has; at each end the best of all lengths is taken at once.
    What is kept of the whole unit is a backpointer and a number per character.
    """
    lengths = [n for n in sorted(pieces.by_length, reverse=True) if n > 1] + [1]
    reach, size = max(lengths), len(codes)
    step, number = np.zeros(size + 1, np.int16), np.zeros(size + 1, np.int32)
    back = np.array(lengths)
    tail = np.full(reach, -np.inf)  # the best sums of the places before the block
    tail[-1] = 0
    for begin in range(0, size, _ALONE):
        end = min(begin + _ALONE, size)
        first = max(0, begin - reach)
        wide = codes[first:end].astype(np.uint64)
        values = np.full((len(lengths), end - begin), -np.inf)
        which = np.zeros((len(lengths), end - begin), np.int32)
        key = np.zeros(len(wide), np.uint64)
        for length in range(1, min(reach, len(wide)) + 1):
            key = key[: len(wide) - length + 1] * _BASE + wide[length - 1 :] + np.uint64(1)
            if length not in pieces.by_length:
                continue
            keys, ids, texts = pieces.by_length[length]
            ends = np.arange(length, len(wide) + 1) - (begin - first)  # of each substring, in the block
            maybe = np.flatnonzero(pieces.filters[length][_leading(key)] & (ends > 0))
            place = np.minimum(np.searchsorted(keys, key[maybe]), len(keys) - 1)
            hit = keys[place] == key[maybe]
            maybe, place = maybe[hit], place[hit]
            for k in range(length):
                same = wide[maybe + k] == texts[place, k]
                if not same.all():
                    maybe, place = maybe[same], place[same]
            row = lengths.index(length)
            values[row, ends[maybe] - 1] = pieces.scores[ids[place]]
            which[row, ends[maybe] - 1] = ids[place]
        unknown = np.flatnonzero(np.isinf(values[-1]))
        values[-1, unknown] = pieces.unknown_score
        which[-1, unknown] = -1 - codes[begin:end][unknown].astype(np.int32)
        best = np.concatenate([tail, np.empty(end - begin)])
        rows = np.ascontiguousarray(values.T)
        chosen = np.empty(end - begin, np.int64)
        for k in range(end - begin):
            offered = best[reach + k - back] + rows[k]
            chosen[k] = top = offered.argmax()  # of equal sums the longest piece
            best[reach + k] = offered[top]
        step[begin + 1 : end + 1] = back[chosen]
        number[begin + 1 : end + 1] = which[chosen, np.arange(end - begin)]
        tail = best[-reach:]
    found, at = [], size
    while at > 0:
        found.append(number[at])
        at -= int(step[at])
    return np.array(found[::-1], np.int64)


def _units(pieces: Pieces, words: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """The words' characters, long words cut where no piece reaches; units of each word."""
    units, of_word = [], np.ones(len(words), np.int64)
    for k, word in enumerate(words):
        codes = _codes(word)
        if len(codes) <= _LONG or not len(pieces.pairs):
            units.append(codes)
            continue
        pair = (codes[:-1].astype(np.int64) << 21) | codes[1:]
        place = np.minimum(np.searchsorted(pieces.pairs, pair), len(pieces.pairs) - 1)
        parts = np.split(codes, np.flatnonzero(pieces.pairs[place] != pair) + 1)
        units += parts
        of_word[k] = len(parts)
    return units, of_word


def _segment(pieces: Pieces, units: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All units' pieces one after the other, and how many each unit has."""
    sizes = np.fromiter(map(len, units), np.int64, len(units))
    many, parts, owners = np.zeros(len(units), np.int64), [], []
    for size in np.unique(sizes):
        group = np.flatnonzero(sizes == size)
        if size > _ALONE:
            for k in group:
                flat = viterbi_alone(pieces, units[k])
                flat, owner = _spell(pieces, flat, np.full(len(flat), k))
                many[k] = len(flat)
                parts.append(flat)
                owners.append(owner)
            continue
        most = max(1, (1 << 17) // int(size))
        for start in range(0, len(group), most):
            at = group[start : start + most]
            ids, count = viterbi(pieces, np.stack([units[k] for k in at]))
            used = np.arange(size) >= size - count[:, None]
            flat, owner = ids[used], np.repeat(at, count)
            if (flat < 0).any():
                flat, owner = _spell(pieces, flat, owner)
                count = np.bincount(owner, minlength=len(units))[at]
            many[at] = count
            parts.append(flat)
            owners.append(owner)
    if not parts:
        return np.empty(0, np.int64), many
    flat, owner = np.concatenate(parts), np.concatenate(owners)
    return flat[np.argsort(owner, kind="stable")], many


def _spell(pieces: Pieces, ids: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unknown characters replaced by the pieces of their bytes."""
    out, kept = [], []
    at = np.flatnonzero(ids < 0)
    last = 0
    for k in at:
        raw = chr(-1 - int(ids[k])).encode("utf-8", "replace")
        out += [ids[last:k], pieces.byte_ids[np.frombuffer(raw, np.uint8)]]
        kept += [owner[last:k], np.full(len(raw), owner[k])]
        last = k + 1
    return np.concatenate(out + [ids[last:]]), np.concatenate(kept + [owner[last:]])


def _gather(values: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` that start at ``begin``, one after the other."""
    at = np.repeat(begin - np.cumsum(sizes) + sizes, sizes)
    at += np.arange(len(at))
    return values[at]


def encode_texts(pieces: Pieces, texts: list[str]) -> list[np.ndarray]:
    """Piece numbers of every text."""
    number: dict[str, int] = {}
    find, rows = pieces.splitter.findall, []
    for text in texts:
        words = find(MARK + text.replace(" ", MARK)) if text else []
        for w in words:
            if w not in number:
                number[w] = len(number)
        rows.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
    units, of_word = _units(pieces, list(number))
    flat, many = _segment(pieces, units)
    if len(many):
        first = np.cumsum(of_word) - of_word
        many = np.add.reduceat(many, first)
    begin = np.cumsum(many) - many
    return [_gather(flat, begin[r], many[r]).astype(np.int32) for r in rows]


def decode_ids(pieces: Pieces, ids: list[int]) -> str:
    """The text of some pieces; bytes that are no UTF-8 become replacement signs."""
    text = b"".join(map(pieces.surfaces.__getitem__, ids)).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(r) for r in rows]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))


def encode(
    docs: DataFrame, model: str | Pieces = MODEL, text_col: str = "text",
    keep: dict[str, str] | None = None, check: bool = False, ids: bool = True,
) -> DataFrame:
    """``keep`` (by default the id), the piece numbers of each text and their count.

    ``check`` also decodes them and tells whether the text came back; ``ids=False``
    leaves the numbers out.
    """
    pieces = model if isinstance(model, Pieces) else Pieces.load(model)
    sent = docs.sparkSession.sparkContext.broadcast(pieces)

    def work(texts: list[bytes]) -> dict[str, pa.Array]:
        own = sent.value
        plain = [t.decode("utf-8", "replace") for t in texts]
        rows = encode_texts(own, plain)
        made = {"piece_ids": _lists(rows)} if ids else {}
        made["n_pieces"] = pa.array([len(r) for r in rows], pa.int32())
        if check:
            back = [decode_ids(own, r.tolist()) for r in rows]
            made["round_trip"] = pa.array(
                [a == b.replace(MARK, " ") for a, b in zip(back, plain)], pa.bool_()
            )
        return made

    schema = "piece_ids array<int>, " * ids + "n_pieces int" + ", round_trip boolean" * check
    keep = {"doc_id": "doc_id"} if keep is None else keep
    return map_texts(docs, text_col, keep, work, schema, most=12 << 20)


def decode(
    encoded: DataFrame, model: str | Pieces = MODEL, ids_col: str = "piece_ids", out: str = "text"
) -> DataFrame:
    """``encoded`` with the text of its piece numbers as the column ``out``."""
    pieces = model if isinstance(model, Pieces) else Pieces.load(model)
    sent = encoded.sparkSession.sparkContext.broadcast(pieces)
    names = [c for c in encoded.columns if c != out]
    kinds = dict(encoded.dtypes)
    schema = ", ".join([f"`{n}` {kinds[n]}" for n in names] + [f"`{out}` string"])

    def run(batches):
        for batch in batches:
            texts = [decode_ids(sent.value, r or []) for r in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array(texts, pa.string())], names + [out]
            )

    return encoded.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(run, schema)
