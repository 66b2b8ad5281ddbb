"""Exact batch encoding with byte-pair tokenizers given as JSON files.

``tokenizers`` is the reference and takes every text that the faster ways
below can't be shown to encode alike:

* ``RankMerger`` joins pieces by the rank of the joined token (tiktoken)
  instead of by merge pairs.  Where each join made is also the
  tokenizer's own merge, both take the same steps: the merge pairs are a
  subset of the joins with the same ranks, so the lowest join is the
  lowest merge.  Joins inside a final token are those made when that
  token's bytes stand alone, so it is enough to know, for each token,
  whether its own joins are merges.  The few tokens for which they aren't
  are listed when the file is loaded, and a text with such a token goes to
  ``tokenizers``.
* Texts with characters from U+0370 on (U+0100 on for ``WordEncoder``,
  whose tokenizer normalises), or with a special token's string, go there
  as well, so Unicode versions don't matter.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

# White space as the tokenizers see it is Python's \s without \x1c-\x1f.
_UNIT = re.compile(r"[\S\x1c-\x1f]+")
_FROM_0370 = re.compile("[^\x00-ͯ]")

_loaded: dict[tuple[str, bool], object] = {}


def load_tokenizer(path: str, names_plain: bool = False):
    """The tokenizer in the file, without truncation or padding.

    names_plain: special tokens' names inside a text are plain text."""
    if (path, names_plain) not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        if names_plain:
            tok.encode_special_tokens = True
        _loaded[path, names_plain] = tok
    return _loaded[path, names_plain]


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class RankMerger:
    """tiktoken over a tokenizer file's vocabulary; ids of whole strings.

    end: a byte after each word, standing for the vocabulary's end-of-word
    suffix.
    """

    def __init__(self, spec: dict, pattern: str, end: bytes = b""):
        import tiktoken

        model = spec["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        chars = byte_of_char()

        def raw(token: str) -> bytes:
            last = bool(suffix) and token.endswith(suffix)
            return bytes(chars[c] for c in (token[: -len(suffix)] if last else token)) + end * last

        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        base = [c for c in sorted(chars, key=chars.get)]
        ranks = {bytes([chars[c]]): i for i, c in enumerate(base)}
        ids = [vocab.get(c, -1) for c in base]
        if suffix:  # a word's last character already carries the suffix
            for c in base:
                ranks[bytes([chars[c]]) + end] = len(ids)
                ids.append(vocab.get(c + suffix, -1))
        odd = np.zeros(len(ids) + len(pairs), bool)
        for left, right in pairs:
            a, b = raw(left), raw(right)
            if a + b in ranks:
                raise ValueError("a token has two merges")
            odd[len(ids)] = odd[ranks[a]] or odd[ranks[b]] or self._parts(a + b, ranks, end) != [a, b]
            ranks[a + b] = len(ids)
            ids.append(vocab[left + right])
        self.ids, self.ranks, self.odd = np.array(ids, np.int64), ranks, odd
        self.unknown = self.ids < 0
        self.core = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def _parts(token: bytes, ranks: dict[bytes, int], end: bytes) -> list[bytes]:
        """What a token's bytes are joined to by the ranks so far."""
        parts = [token[i : i + 1] for i in range(len(token))]
        if end and parts[-1] == end and len(parts) > 1:
            parts[-2:] = [parts[-2] + end]
        while len(parts) > 1:
            joined = [ranks.get(parts[i] + parts[i + 1], 1 << 60) for i in range(len(parts) - 1)]
            low = min(joined)
            if low == 1 << 60:
                break
            i = joined.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def merge(self, text: str) -> np.ndarray:
        """Ranks of the tokens, to be looked up in ``ids``."""
        return self.core.encode_to_numpy(text)


def _spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


class ByteEncoder:
    """A byte-level tokenizer that keeps white space: ids of texts, and the
    bytes of ids."""

    def __init__(self, path: str, names_plain: bool = False):
        import public_tokenizers

        spec = _spec(path)
        self.tok = load_tokenizer(path, names_plain)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.plain = (
            spec["normalizer"] is None
            and spec["model"]["type"] == "BPE"
            and not spec["model"].get("end_of_word_suffix")
            and (spec["pre_tokenizer"] or {}).get("type") == "ByteLevel"
            and spec["pre_tokenizer"]["use_regex"]
            and not spec["pre_tokenizer"]["add_prefix_space"]
        )
        self.merger = RankMerger(spec, public_tokenizers.PATTERN) if self.plain else None
        chars = byte_of_char()
        names = dict(spec["model"]["vocab"]) | {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.pieces[i] = bytes(chars[c] for c in name) if all(c in chars for c in name) else name.encode()
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)

    def encode(self, text: str) -> np.ndarray:
        if self.merger and not _FROM_0370.search(text) and not any(s in text for s in self.special):
            ranks = self.merger.merge(text)
            if not (self.merger.odd[ranks].any() or self.merger.unknown[ranks].any()):
                return self.merger.ids[ranks].astype("<u4")
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4")

    def encode_words(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """ids, and for each whether a pre-token begins with it."""
        e = self.tok.encode(text, add_special_tokens=False)
        word = np.array([-1 if w is None else w for w in e.word_ids], np.int64)
        begins = np.ones(len(word), bool)
        begins[1:] = (word[1:] != word[:-1]) | (word[1:] < 0)
        return np.array(e.ids, "<u4"), begins

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.pieces.__getitem__, ids.tolist())).decode("utf-8", "replace")


class WordEncoder:
    """A tokenizer that drops white space: ids of texts as bytes of
    little-endian unsigned integers.

    Texts of Latin-1 characters are cut into words here and merged by rank;
    others are taken unit by unit, and only units with other characters go
    to the library.
    """

    # Fixed value: the file's word pattern.
    _PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    _LETTERS = "a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff"
    _NUMBERS = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
    #: The same, for lower-case Latin-1 text without \x1c-\x1f.
    _WORDS = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+")
    _OTHER = re.compile("[^\x00-\xff]|[\x00\x1c-\x1f]")

    def __init__(self, path: str, dtype: str = "<u4"):
        spec = _spec(path)
        self.tok, self.dtype = load_tokenizer(path), np.dtype(dtype)
        self.special = [t["content"].lower() for t in spec["added_tokens"]]
        first = ((spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        self.merger = None
        if first.get("pattern", {}).get("Regex") == self._PATTERN and spec["model"].get("end_of_word_suffix"):
            self.merger = RankMerger(spec, r"[^\x00]*\x00", b"\x00")
            self.ids = self.merger.ids.astype(self.dtype)
            self.doubtful = self.merger.odd | self.merger.unknown

    def _fast(self, text: str) -> bytes | None:
        """ids of a text, or None where they aren't sure to be right."""
        lower = text.lower()
        if self._OTHER.search(lower) or ("<|" in lower and any(x in lower for x in self.special)):
            return None
        words = self._WORDS.findall(lower)
        if not words:
            return b""
        ranks = self.merger.merge("\x00".join(words) + "\x00")
        if self.doubtful[ranks].any():
            return None
        return self.ids[ranks].tobytes()

    def _by_library(self, units: list[str]) -> list[bytes]:
        fast = getattr(self.tok, "encode_batch_fast", self.tok.encode_batch)
        return [np.array(e.ids, self.dtype).tobytes() for e in fast(units, add_special_tokens=False)]

    def _by_units(self, text: str) -> bytes:
        units = _UNIT.findall(text)
        out = [self._fast(u) for u in units]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(rest, self._by_library([units[i] for i in rest]), strict=True):
            out[i] = x
        return b"".join(out)

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.merger:
            return self._by_library(texts)
        return [self._by_units(t) if (x := self._fast(t)) is None else x for t in texts]


_encoders: dict[tuple, object] = {}


def encoder(kind: type, *args):
    """One encoder per worker process."""
    key = (kind, *args)
    if key not in _encoders:
        _encoders[key] = kind(*args)
    return _encoders[key]
