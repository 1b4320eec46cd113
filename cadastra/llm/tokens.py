"""Token ids of whole texts with a ready-made tokenizer file (inside Spark tasks).

``encode`` gives the ids that ``Tokenizer.encode(text, add_special_tokens=False)``
gives. A byte-level BPE never merges across its pre-tokens, so a text can be
cut at pre-token boundaries, every distinct piece encoded once by the library,
and the pieces' ids joined; Arrow finds the distinct pieces of a slice of texts
and joins their ids. Where no white space stands beside white space, a
space begins a pre-token, any other white space is one, and a full stop or
comma between a letter or digit and a space is one: such texts are cut there
with plain string functions. A piece of Latin letters is one pre-token, and so
are the ASCII marks after it: those go to the library's model as they are,
without its search for pre-tokens. A text with runs of white space is cut into runs
of other characters, each with the one space before it, and the white space
between them. A Python worker keeps the ids of the pieces it has used lately
(two generations of a bounded table). Texts where the argument does not hold go
to the library whole: those with a special token's string, or with a control
character that Python and the library do not agree is white space. Other kinds
of tokenizer files always go whole.
"""

from __future__ import annotations

import gc
import json
import os
import re
from array import array
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_CACHE = 350_000  # pieces of one generation of the table that a Python worker keeps; there are two
JOINED_PIECES = 64  # new pieces that go to the library as one text
_CHUNK = re.compile(r" ?\S+|\s+(?!\S)|\s+")
_ODD_SPACE = "\x1c\x1d\x1e\x1f\x85᠎​﻿"
_RUNS = re.compile(r"\s\s")
_OTHER_SPACE = re.compile(r"[^\S \n]")
_OTHER_SPACES = [c for c in map(chr, range(0x3001)) if _OTHER_SPACE.match(c)]
_STOP_IN_RUN = re.compile(r"[.,](?<=[\W_].) ")  # a stop that may belong to a longer pre-token
_WORD = re.compile(r"( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-&(-/:-@\[-^`{-~]*)")  # no apostrophe: it may begin a pre-token
_TAILS = 10_000  # marks after words whose ids are kept
_JOINED = "\x01"  # marks a piece that has no space before it
_LOADED: dict[str, "ChunkEncoder"] = {}


def _byte_letters() -> str:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(0x100, 0x200))
    return "".join(chr(b) if b in shown else chr(next(other)) for b in range(256))


_BYTE_LETTERS = _byte_letters()
_LETTERS_OF = {b: c for b, c in enumerate(_BYTE_LETTERS) if b != 10}  # line feeds stay between words


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        pre = spec.get("pre_tokenizer") or {}
        self.by_chunk = (
            pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and spec["model"]["type"] == "BPE" and not spec.get("normalizer")
            and not spec["model"].get("dropout"))
        feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line_feed = feed[0] if self.by_chunk and len(feed) == 1 else None
        self.model = self.tokenizer.model
        self.tails: dict[str, bytes] = {"": b""}
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _ids_joined(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces: many in one text, with line feeds between them where each is then a pre-token of its own."""
        if self.line_feed is None:
            return self._ids(pieces)
        apart = [not p or "\n" in p or p[-1].isspace() for p in pieces]
        plain = [p for p, a in zip(pieces, apart) if not a]
        texts = ["\n".join(plain[at : at + JOINED_PIECES]) for at in range(0, len(plain), JOINED_PIECES)]
        found: list[bytes] = []
        for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            ids = np.array(e.ids, "<u4")
            blob, start = ids.tobytes(), 0
            for at in (4 * np.flatnonzero(ids == self.line_feed)).tolist():
                found.append(blob[start:at])
                start = at + 4
            found.append(blob[start:])
        if len(plain) == len(pieces):
            return found
        joined, single = iter(found), iter(self._ids([p for p, a in zip(pieces, apart) if a]))
        return [next(single if a else joined) for a in apart]

    def _tail_ids(self, tail: str) -> bytes:
        if (found := self.tails.get(tail)) is None:
            found = self._ids([tail])[0]
            if len(self.tails) < _TAILS:
                self.tails[tail] = found
        return found

    def _new_ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces; words of Latin letters are one pre-token each, with the marks after them two."""
        matches = list(map(_WORD.fullmatch, pieces))
        words = "\n".join([m[1] for m in matches if m])
        words = words.replace(" ", _BYTE_LETTERS[32]) if words.isascii() else (
            words.encode("utf-8").decode("latin-1").translate(_LETTERS_OF))
        tokenize = self.model.tokenize
        named = (array("I", [x.id for x in tokenize(w)]).tobytes() for w in words.split("\n"))
        other = iter(self._ids_joined([p for p, m in zip(pieces, matches) if not m]))
        return [next(other) if not m else next(named) + self._tail_ids(m[2]) if m[2] else next(named) for m in matches]

    def _marked(self, text: str) -> str | None:
        """The text with a space before every piece, and a mark in front of one that stands there without it.

        None if white space stands beside white space (or the mark is in the text).
        """
        plain = text.isascii() and not ("\t" in text or "\r" in text or "\v" in text or "\f" in text)
        other = not plain and any(c in text for c in _OTHER_SPACES)
        runs = _RUNS.search(text) if other else "  " in text or "\n\n" in text or " \n" in text or "\n " in text
        if runs or _JOINED in text:
            return None
        if not _STOP_IN_RUN.search(text) and text[1:2] != " ":
            text = text.replace(". ", " \x01. ").replace(", ", " \x01, ")
        text = text.replace("\n", " \x01\n \x01")
        if other:
            text = _OTHER_SPACE.sub(" \x01\\g<0> \x01", text)
        return _JOINED + text

    def _piece_ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces, from the table or the library."""
        found = list(map(self.cache.get, pieces))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if len(self.cache) + len(missing) > CHUNK_CACHE:  # pieces not used for a generation are forgotten
            self.older = self.cache
            self.cache = dict(zip(compress(pieces, found), filter(None, found)))
        older = self.older.get
        unseen = []
        for i in missing:
            if (ids := older(pieces[i])) is None:
                unseen.append(i)
            else:
                found[i] = ids
        new = [pieces[i] for i in unseen]
        for i, ids in zip(unseen, self._new_ids([p[1:] if p[:1] == _JOINED else " " + p for p in new])):
            found[i] = ids
        self.cache.update(zip(map(pieces.__getitem__, missing), map(found.__getitem__, missing)))
        return found

    def end_task(self) -> None:
        """Forget the older generation and hand back what Arrow keeps, so that an idle worker holds one table."""
        self.older = {}
        pa.default_memory_pool().release_unused()

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null is the empty text."""
        collecting = gc.isenabled()
        gc.disable()  # strings and bytes hold no cycles; the collector would walk the table again and again
        try:
            return self._encode_many(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode_many(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        whole: list[int] = []  # texts that go to the library whole,
        spaced: list[int] = []  # those whose pieces a space divides,
        spaced_texts: list[str] = []
        cut: list[int] = []  # and those with runs of white space
        cut_pieces: list[list[str]] = []
        for i, text in enumerate(texts):
            if not text:
                continue
            if not self.by_chunk or any(c in text for c in _ODD_SPACE) or any(s in text for s in self.special):
                whole.append(i)
            elif (marked := self._marked(text)) is not None:
                spaced.append(i)
                spaced_texts.append(marked)
            else:
                cut.append(i)
                cut_pieces.append([_JOINED + c for c in _CHUNK.findall(text)])
        if spaced or cut:
            lists = pc.split_pattern(pa.array(spaced_texts, pa.large_string()), " ")
            pieces = pa.concat_arrays([lists.flatten(), pa.array(chain.from_iterable(cut_pieces), pa.large_string())])
            ends = np.cumsum([*pc.list_value_length(lists).to_pylist(), *map(len, cut_pieces)])
            coded = pieces.dictionary_encode()  # every distinct piece is looked up once
            ids = pa.array(self._piece_ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(coded.indices)
            offsets, data = np.frombuffer(ids.buffers()[1], np.int64), memoryview(ids.buffers()[2] or b"")
            start = 0
            for i, end in zip(spaced + cut, offsets[ends].tolist()):
                out[i] = bytes(data[start:end])
                start = end
        if whole:
            for i, found in zip(whole, self._ids([texts[i] for i in whole])):
                out[i] = found
        return out


def encoder(path: str) -> ChunkEncoder:
    """The encoder of one file, loaded once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = ChunkEncoder(path)
    return _LOADED[path]


def slices(texts: list[str | None], size: int = 1024, characters: int = 1 << 22):
    """Consecutive slices of a batch, so that few texts' ids are in memory at once: at most ``size`` texts,
    and one text or at most ``characters`` in all."""
    at, total = 0, 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if i > at and (i - at == size or total + n > characters):
            yield at, texts[at:i]
            at, total = i, 0
        total += n
    if at < len(texts):
        yield at, texts[at:]
