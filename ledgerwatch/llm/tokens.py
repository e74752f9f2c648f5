"""Token ids of whole texts by a public tokenizer.

A byte-level vocabulary is merged by rank: its file's tokens are the byte strings and their ids the ranks, so
``tiktoken`` gives the ids that the ``tokenizers`` library gives for the file, in a third of the time
and without a cache of ours.

The other kind of vocabulary lowers text and drops white space. It cuts at every white space and never
looks across, so the ids of a text are those of its chunks in a row. A chunk of letters and closing punctuation needs no
normaliser or pre-tokeniser: its words are merged by rank with ``tiktoken`` if the
file's ids follow its merges, and go to the library's model otherwise. Any other chunk goes to the library whole.
Texts of ASCII and Latin letters are merged many at a time. The chunks of others, which repeat a lot, reach a tokeniser
only when new, and a bounded number is kept.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
from typing import NamedTuple

import numpy as np

#: Chunks in each of the two generations kept per Python worker and vocabulary.
CACHED = 300_000
_CLOSING = ".,!?;:*#$%&|"
_END = "\x00"
_ENDED = r"[^\x00]+\x00"
# A byte in a text: part of a word, closing punctuation, cut, anything else.
_LETTER, _CLOSES, _CUT, _OTHER = range(4)
# Fixed value: how a byte-level vocabulary cuts a text before merging.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Chunks(dict):
    """Chunk to its ids as little-endian unsigned 32-bit bytes, made when a chunk is first asked for.

    When the young generation (this dictionary) is full it becomes the old one; a chunk met again moves back.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.old: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        cut = self.tokenizer.pre_tokenizer
        self.letters = {c: cut.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x250) if chr(c).isalpha()}
        self.merged = _merged(path)
        #: By id, whether ``tiktoken`` gives the id for a piece that the library spells otherwise.
        self.unlike = np.zeros(len(self.merged.ends) if self.merged else 0, bool)
        for rank, piece in self.merged.spelled.items() if self.merged else ():
            if piece and (piece.isalpha() or not piece.strip(_CLOSING)) and not _beyond().search(piece):
                self.unlike[rank] = [t.id for t in self.tokenizer.model.tokenize(piece.translate(self.letters))] != [rank]

    def bound(self) -> None:
        if len(self) > CACHED:
            self.old = dict(self)
            self.clear()
        if len(self.pieces) > CACHED:
            self.pieces = {}

    def whole(self, text: str) -> bytes:
        found = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(found)}I", *found)

    def piece(self, piece: str) -> bytes:
        """Ids of a lower-case word or a run of punctuation.

        One that is a token itself goes to the library, as ``tiktoken`` gives a token without merging.
        """
        ids = self.pieces.get(piece)
        if ids is None:
            if self.merged is None or piece in self.merged.whole:
                spelled = piece if piece.isascii() else piece.translate(self.letters)
                found = [t.id for t in self.tokenizer.model.tokenize(spelled)]
            else:
                found = self.merged.ranked.encode_ordinary(piece + _END)
            ids = self.pieces[piece] = struct.pack(f"<{len(found)}I", *found)
        return ids

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            stem = chunk.rstrip(_CLOSING)
            if stem.isalpha() and (stem.isascii() or (max(stem) < "\u0250" and stem.lower().isalpha())):
                ids = self.piece(stem.lower())
                if len(stem) < len(chunk):
                    ids += self.piece(chunk[len(stem) :])
            else:
                ids = self.whole(chunk)
        self[chunk] = ids
        return ids


@functools.cache
def _worker_cache(path: str) -> _Chunks:
    return _Chunks(path)


def _byte_values() -> dict[str, int]:
    """Character to byte in a byte-level vocabulary: printable bytes are themselves, others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class _Merged(NamedTuple):
    ranked: object
    #: The pieces that are one token.
    whole: frozenset[str]
    #: By id: whether it ends a piece, and the piece that it is.
    ends: np.ndarray
    spelled: dict[int, str]


@functools.cache
def _merged(path: str) -> _Merged | None:
    """A word vocabulary to be merged by rank; None if its ids do not follow its merges.

    A byte that no piece contains stands for the end of a word, and is merged first with the byte before it.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    suffix, vocab = model.get("end_of_word_suffix"), model["vocab"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    values, known = _byte_values(), 512 + len(merges)
    if not suffix or [vocab.get(a + b) for a, b in merges] != list(range(512, known)):
        return None
    if {vocab.get(c) for c in values} != set(range(256)) or {vocab.get(c + suffix) for c in values} != set(range(256, 512)):
        return None
    ranks, whole, ends = {}, {}, np.zeros(known, bool)
    for token, rank in vocab.items():
        if rank >= known:  # a special token
            continue
        last = token.endswith(suffix)
        spelled = bytes(values[c] for c in (token[: -len(suffix)] if last else token))
        ends[rank] = last
        if last:
            whole[rank] = spelled.decode("utf-8", "replace")
            spelled += _END.encode()
        ranks[spelled] = rank
    return _Merged(tiktoken.Encoding("words", pat_str=_ENDED, mergeable_ranks=ranks, special_tokens={}), frozenset(whole.values()), ends, whole)


@functools.cache
def _ranked(path: str):
    import tiktoken

    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    if stored["pre_tokenizer"]["type"] != "ByteLevel" or stored["normalizer"] is not None:
        raise ValueError(f"not a byte-level vocabulary: {path}")
    special = {t["content"] for t in stored["added_tokens"]}
    values = _byte_values()
    ranks = {bytes(values[c] for c in token): rank for token, rank in stored["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("byte-level", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def _beyond() -> re.Pattern:
    """A character that is neither ASCII nor a letter of two bytes whose lower case is one too."""
    letters = [c for c in map(chr, range(0xC0, 0x250)) if c.isalpha() and len(c.lower()) == 1 and c.lower().isalpha() and c.lower() < "\u0250"]
    return re.compile(f"[^\x00-\x7f{''.join(letters)}]")


@functools.cache
def _kinds() -> np.ndarray:
    """What a byte is in a text without characters ``_beyond``."""
    kind = np.full(256, _OTHER, np.uint8)
    kind[65:91] = kind[97:123] = kind[128:] = _LETTER
    kind[np.frombuffer(_CLOSING.encode(), np.uint8)] = _CLOSES
    kind[[10, 32]] = _CUT
    return kind


def _many(texts: list[str], cache: _Chunks) -> list[bytes]:
    """Ids of each text, none with a character ``_beyond``, by one call of ``tiktoken`` for all their words.

    A text's ids are a stretch of that call's, into which those of chunks that went to the library are put.
    """
    merged = cache.merged
    joined = "\n".join(texts) + "\n"
    data, low = (np.frombuffer(t.encode(), np.uint8) for t in (joined, joined.lower()))  # alike in length
    after = np.cumsum([(len(t) if t.isascii() else len(t.encode())) + 1 for t in texts])
    kind = _kinds()[data]
    before = np.concatenate([np.array([_CUT], np.uint8), kind[:-1]])
    odd = (kind == _OTHER) | ((kind == _CLOSES) & (before == _CUT)) | ((kind == _LETTER) & (before == _CLOSES))
    cuts = np.flatnonzero(kind == _CUT)
    chunk = np.unique(np.searchsorted(cuts, np.flatnonzero(odd)))
    first, last = np.where(chunk > 0, cuts[chunk - 1] + 1, 0), cuts[chunk]
    # Each byte once, a letter before closing punctuation and an end; no odd chunk, and no cut but after a piece.
    often = np.ones(len(data), np.uint8)
    twice = np.flatnonzero((kind[:-1] == _LETTER) & (kind[1:] == _CLOSES))
    often[twice] = 2
    often[(kind == _CUT) & (before == _CUT)] = 0
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        often[a : b + 1] = 0
    pieces = np.repeat(np.where(kind == _CUT, np.uint8(0), low), often)
    twice = twice[often[twice] == 2]
    end = np.cumsum(often, dtype=np.int64)
    pieces[end[twice] - 1] = 0
    ids = np.array(merged.ranked.encode_ordinary(pieces.tobytes().decode()), "<u4")
    raw = ids.tobytes()
    closed = merged.ends[ids]
    begins = np.concatenate([[0], np.flatnonzero(closed) + 1])  # of pieces among the ids
    passed = np.concatenate([[0], np.cumsum(pieces == 0)])  # pieces that ended before a byte
    at = lambda byte: begins[passed[np.where(byte > 0, end[byte - 1], 0)]]
    bounds = np.concatenate([[0], at(after)])
    # A place among the ids, how many of them go, and what comes instead; by text.
    put: dict[int, list[tuple[int, int, bytes]]] = {}
    owner = np.searchsorted(after, first, "right").tolist()
    for k, place, a, b in zip(owner, at(first).tolist(), first.tolist(), last.tolist(), strict=True):
        put.setdefault(k, []).append((place, 0, cache[data[a:b].tobytes().decode()]))
    alone = np.flatnonzero(cache.unlike[ids] & np.concatenate([[True], closed])[:-1])
    for k, place in zip((np.searchsorted(bounds, alone, "right") - 1).tolist(), alone.tolist(), strict=True):
        put.setdefault(k, []).append((place, 1, cache.piece(merged.spelled[int(ids[place])])))
    out = []
    for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        parts = []
        for place, gone, instead in sorted(put.get(k, ()), key=lambda p: p[:2]):
            parts += [raw[4 * a : 4 * place], instead]
            a = place + gone
        out.append(b"".join(parts) + raw[4 * a : 4 * b] if parts else raw[4 * a : 4 * b])
    return out


def encode(texts: list[str | None], path: str, spaced: bool) -> list[bytes]:
    """Ids of each text as bytes of little-endian unsigned 32-bit integers; null and empty give none.

    ``spaced``: white space yields ids (byte-level vocabularies). Otherwise it only separates.
    """
    if spaced:
        ranked = _ranked(path)
        return [ranked.encode_to_numpy(t, disallowed_special=()).astype("<u4").tobytes() if t else b"" for t in texts]
    cache = _worker_cache(path)
    cache.bound()
    many = [bool(t) and cache.merged is not None and (t.isascii() or not _beyond().search(t)) for t in texts]
    merged = iter(_many([t for t, one in zip(texts, many, strict=True) if one], cache) if any(many) else ())
    ids = cache.__getitem__
    return [
        next(merged) if one else b"".join(map(ids, t.replace("\n", " ").split(" "))) if t else b""
        for t, one in zip(texts, many, strict=True)
    ]


def in_runs(texts: list[str | None], most: int = 1 << 20):
    """Index ranges of texts of about ``most`` characters together."""
    first = held = 0
    for k, text in enumerate(texts):
        held += len(text or "")
        if held >= most:
            yield first, k + 1
            first, held = k + 1, 0
    if first < len(texts):
        yield first, len(texts)
