"""Fast exact encoding of whole texts with a tokenizers file.

A text is cut before a blank or a line feed that stands between characters which are not white space.
No token of the supported files crosses such a cut, and neither side changes how the other is split,
so the ids of a text are the ids of its chunks in a row. Natural text repeats its chunks, so each
worker encodes a chunk once and keeps its ids, up to a fixed number of chunks.
"""

from __future__ import annotations

import gc
import json
import os
import re

import numpy as np

#: Chunks that a worker keeps before it starts anew, about 200 bytes each; longer chunks are not kept.
KEEP = 200_000
LONGEST = 14
#: Chunks that are encoded as one text.
TOGETHER = 4096
MARK = "\x01"
#: A blank after a character that surely isn't white space.
CUT = re.compile(r"(?<=[\w!-/:-@\[-`{-~]) ")

#: A plain word and what closes it, where lowering is the same in all libraries.
PLAIN = re.compile(r"([a-zA-ZÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=?@\[-`{-~]*)")
#: The split of files that drop white space, mark word ends and keep letter runs whole (a fixed value).
LETTER_RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str, words: int = 300_000) -> ChunkEncoder:
    """This worker's encoder for a tokenizer file, which keeps so many plain words, about 200 bytes each."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    _encoders[path].words_kept = words
    return _encoders[path]


def forget() -> None:
    """Drop this worker's encoders with all that they keep."""
    _encoders.clear()


def byte_lengths(tokenizer) -> np.ndarray | None:
    """The bytes that each id stands for, where every byte of a text belongs to one token; else none."""
    told = json.loads(tokenizer.to_str())
    if told["normalizer"] or (told["pre_tokenizer"] or {}).get("type") != "ByteLevel":
        return None
    special = {a["content"]: len(a["content"].encode()) for a in told["added_tokens"]}
    vocab = tokenizer.get_vocab(with_added_tokens=True)
    out = np.zeros(max(vocab.values()) + 1, np.int64)
    for token, i in vocab.items():
        out[i] = special.get(token, len(token))
    return out


def word_tokenizer(tokenizer):
    """For a file that drops white space and lowers letters: a tokenizer with its model for plain lower
    words between blanks, and which ids end a word; else none."""
    told = json.loads(tokenizer.to_str())
    steps = [n["type"] for n in (told["normalizer"] or {}).get("normalizers", ())]
    splits = (told["pre_tokenizer"] or {}).get("pretokenizers", ())
    pattern = splits[0].get("pattern", {}).get("Regex") if splits else None
    end = told["model"].get("end_of_word_suffix")
    if steps != ["NFC", "Replace", "Lowercase"] or pattern != LETTER_RUNS or not end:
        return None
    told |= {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, splits[1]]}}
    vocab = tokenizer.get_vocab(with_added_tokens=True)
    ends = np.zeros(max(vocab.values()) + 1, bool)
    ends[[i for t, i in vocab.items() if t.endswith(end)]] = True
    return type(tokenizer).from_str(json.dumps(told)), ends


class ChunkEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        gc.set_threshold(200_000, 50, 100)  # the chunks hold no cycles
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.lengths = byte_lengths(self.tokenizer)
        self.words = word_tokenizer(self.tokenizer)
        self.known: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}
        self.closed: set[str] = set()  # of these, those that a symbol closes
        self.words_kept = 300_000

    def plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in found]

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk; where tokens keep all bytes, of many chunks at once."""
        if self.lengths is None and self.words:
            return self.encode_words(chunks)
        if self.lengths is None or len(chunks) < 2:
            return self.plain(chunks)
        out = []
        groups = [chunks[i : i + TOGETHER] for i in range(0, len(chunks), TOGETHER)]
        for group, joined in zip(groups, self.plain(["".join(g) for g in groups]), strict=True):
            ends = np.cumsum([len(c.encode()) for c in group])
            at = np.searchsorted(np.cumsum(self.lengths[np.frombuffer(joined, "<u4")]), ends, "right")
            at = [0, *(4 * at).tolist()]
            out += [joined[a:b] for a, b in zip(at, at[1:], strict=False)]
        return out

    def encode_joined(self, words: list[str]) -> list[bytes]:
        """The ids of lower words of Latin-1 letters, many at once and without the file's normalizer."""
        out: list[bytes] = []
        tokenizer, ends = self.words
        for i in range(0, len(words), TOGETHER):
            group = words[i : i + TOGETHER]
            ids = np.asarray(tokenizer.encode_batch_fast([" ".join(group)], add_special_tokens=False)[0].ids, "<u4")
            at, flat = [0, *(4 * (np.flatnonzero(ends[ids]) + 1)).tolist()], ids.tobytes()
            out += [flat[a:b] for a, b in zip(at, at[1:], strict=False)]
        return out

    def encode_words(self, chunks: list[str]) -> list[bytes]:
        """The ids of chunks that begin with a blank, many of them a plain word and what closes it."""
        match = PLAIN.fullmatch
        found = [(m[1].lower(), m[2]) if (m := match(c, 1)) else (None, c) for c in chunks]
        words = list({w for w, _ in found if w})
        ids = dict(zip(words, self.encode_joined(words), strict=True))
        rest = list({p for _, p in found if p})
        more = dict(zip(rest, self.plain(rest), strict=True)) | {"": b""}
        return [ids[w] + more[p] if w else more[p] for w, p in found]

    def split(self, text: str) -> list[str]:
        """The chunks; all but the first and those that begin with a line feed follow a blank."""
        if self.lengths is None:  # white space is dropped, letters are lowered
            text = text.replace("\n", " ")
            return (text.lower() if text.isascii() and "<|" not in text else text).split(" ")
        return text.replace("\n", " \n").split(" ")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; null counts as empty."""
        return self.encode_spaced(texts) if self.words or self.lengths is not None else self.encode_cut(texts)

    def spaced_chunks(self, text: str) -> list[str] | None:
        """Chunks with full stops and commas before white space apart; none where that may not be exact.
        ``MARK`` begins a chunk that follows the one before at once."""
        if not text:
            return []
        try:
            text.encode("latin-1")  # where lowering and letters are the same in all libraries
        except UnicodeEncodeError:
            return None
        if self.lengths is None:
            spaced = f" {text} ".replace("\n", " ").replace(". ", " . ").replace(", ", " , ").lower()
            return None if any(p in spaced for p in (" . . ", " . , ", " , . ", " , , ")) else spaced.split(" ")
        if MARK in text:
            return None
        spaced = f"{MARK}{text} ".replace("\n", " \n").replace(". ", f" {MARK}. ").replace(", ", f" {MARK}, ")
        return None if f"{MARK}. {MARK}" in spaced or f"{MARK}, {MARK}" in spaced else spaced[:-1].split(" ")

    def encode_spaced(self, texts: list[str | None]) -> list[bytes]:
        """Full stops and commas before white space are chunks of their own, so far fewer chunks differ.
        That is exact unless one follows a chunk that a symbol closes; such texts are cut at blanks only."""
        chunks, cut, new = [], set(), set()
        for i, t in enumerate(texts):
            parts = self.spaced_chunks(t or "")
            if parts is None:
                cut.add(i)
            chunks.append(parts or [])
            new.update(chunks[-1])
        dropped = self.lengths is None
        if len(self.spaced) + len(new) > self.words_kept:
            self.spaced, self.closed = {}, set()
        if dropped:
            self.spaced[""] = b""
        new = {c for c in new if c not in self.spaced}
        alone = {".", ","} if dropped else {f"{MARK}.", f"{MARK},"}
        bad = {c for c in new if not c or c[-1].isspace() or c == MARK}
        closed = {c for c in new if not c[-1:].isalnum()} - alone - bad
        self.closed |= closed
        if bad or self.closed:
            for i, parts in enumerate(chunks):
                if not bad.isdisjoint(parts):
                    cut.add(i)
                elif not self.closed.isdisjoint(parts) and any(y in alone and x in self.closed for x, y in zip(parts, parts[1:], strict=False)):
                    cut.add(i)
        order = [c for c in new if c not in bad]
        if dropped:
            plain = [c for c in order if c.isalpha()]
            self.spaced.update(zip(plain, self.encode_joined(plain), strict=True))
            rest = [c for c in order if c not in self.spaced]
            self.spaced.update(zip(rest, self.encode_words([" " + c for c in rest]), strict=True))
        else:
            first = [c for c in order if c[0] == MARK]
            self.spaced.update(zip(first, self.plain([c[1:] for c in first]), strict=True))
            rest = [c for c in order if c[0] != MARK]
            self.spaced.update(zip(rest, self.encode_chunks([c if c[0] == "\n" else " " + c for c in rest]), strict=True))
        get = self.spaced.__getitem__
        others = sorted(cut)
        own = dict(zip(others, self.encode_cut([texts[i] for i in others]), strict=True)) if others else {}
        out = [own[i] if i in own else b"".join(map(get, parts)) for i, parts in enumerate(chunks)]
        for c in order:
            if len(c) > LONGEST:
                del self.spaced[c]
                self.closed.discard(c)
        return out

    def encode_cut(self, texts: list[str | None]) -> list[bytes]:
        """Texts as chunks between blanks."""
        chunks = [self.split(t) if t else [""] for t in texts]
        new: set[str] = set()
        for parts in chunks:
            new.update(parts[1:])
        if len(self.known) + len(new) > min(KEEP, self.words_kept):
            self.known = {}
        else:
            new = {c for c in new if c not in self.known}
        dropped = self.lengths is None
        odd = set() if dropped else {c for c in new if not c or c[-1].isspace()}
        if dropped:
            self.known[""] = b""
            new.discard("")
        order = [c for c in new if c not in odd]
        ids = self.encode_chunks([c if c[0] == "\n" else " " + c for c in order])
        self.known.update(zip(order, ids, strict=True))
        get, out = self.known.__getitem__, []
        firsts = self.plain([parts[0] for parts in chunks])
        for t, parts, first in zip(texts, chunks, firsts, strict=True):
            if odd and not odd.isdisjoint(parts) or not dropped and parts[0][-1:].isspace():
                out.append(b"".join(self.plain([p if not i else " " + p for i, p in enumerate(CUT.split(t or ""))])))
            else:
                out.append(first + b"".join(map(get, parts[1:])))
        for c in order:
            if len(c) > LONGEST:
                del self.known[c]
        return out
