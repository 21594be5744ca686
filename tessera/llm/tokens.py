"""Word-wise use of the public tokenizers, for vocabularies whose tokens never cross white space."""

from __future__ import annotations

import re
import struct
import sys
import types
from array import array
from collections.abc import Iterator
from operator import attrgetter
from typing import TYPE_CHECKING

if TYPE_CHECKING:
    import numpy as np

#: Bytes that one generation of a word cache may take; a cache has two.
CACHE_BYTES = 64 << 20
#: Bytes of a cache entry besides those of the word and of what is kept for it (as measured: two objects, their place in the table, and slack).
ENTRY_BYTES = 280
#: Bytes of text whose words are parted together.
CHUNK = 1 << 20
ID = attrgetter("id")


class Remembered:
    """What was found out about words, in two generations bounded by bytes: a word in use stays, others go after a while.

    A subclass's ``learn`` finds out about new words together.
    """

    def __init__(self, limit: int = CACHE_BYTES):
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.limit = self.room = limit

    def of(self, words: list[bytes]) -> Iterator[bytes]:
        """What is known of each of ``words``, in order."""
        if self.room < 0:
            self.older, self.known, self.room = self.known, {}, self.limit
        new = set(words).difference(self.known)
        if new:
            older = self.older
            back = {w: older[w] for w in new if w in older} if older else {}
            new.difference_update(back)
            for found in (back, self.learn(new)):
                self.known.update(found)
                self.room -= ENTRY_BYTES * len(found) + sum(map(len, found)) + sum(map(len, found.values()))
        return map(self.known.__getitem__, words)

    def learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        raise NotImplementedError


def process_wide(key: tuple, make):
    """``make()`` once in a worker process, which outlives its tasks; what another operator kept there goes."""
    kept = sys.modules.setdefault("_tessera_worker", types.ModuleType("_tessera_worker")).__dict__
    if kept.get("key") != key:
        kept["value"] = None  # freed before the next is made
        kept["value"], kept["key"] = make(), key
    return kept["value"]


class WordTokens(Remembered):
    """word (bytes) -> its ids as little-endian uint32 bytes, remembered for the words that come again.

    The vocabulary is lower-case and parts letters from signs, so a word is looked up in lower case and
    without one sign after an ASCII letter.  A new word of printable ASCII and Latin-1 letters needs no
    normalising: it is parted as the vocabulary parts words, and the parts' bytes go straight to its merges.
    Other new words are encoded together, a lone digit between them: every digit is a token of its own, so that token marks the words'
    limits.  Those that hold the digit, or one of the vocabulary's control strings (which it takes as one id, as it stands), are
    encoded one by one.
    """

    MARK = "0"
    PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
    PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")  # as the vocabulary's, for lower-case PLAIN
    SIGNS = {b: 256 + k for k, b in enumerate([*range(33), *range(127, 161), 173])}  # byte-level stand-ins of unprintable bytes

    def __init__(self, path: str, limit: int = 5 * CACHE_BYTES // 4):
        from tokenizers import Tokenizer

        super().__init__(limit)
        self.tokenizer = Tokenizer.from_file(path)
        self.merged = self.tokenizer.model.tokenize
        self.mark, = self._ids(self.MARK)
        self.tails = {c.encode(): struct.pack("<I", *self._ids(c)) for c in ".,;:!?"}
        self.control = [x.content.lower().encode() for x in self.tokenizer.get_added_tokens_decoder().values()]

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _packed(self, text: str) -> bytes:
        ids = self._ids(text)
        return struct.pack(f"<{len(ids)}I", *ids)

    def learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        import numpy as np

        known, tails, merged, own, control = self.known, self.tails, self.merged, self.MARK.encode(), self.control
        found: dict[bytes, bytes] = {}
        waiting: dict[bytes, list[tuple[bytes, bytes]]] = {}  # cores left to the whole tokenizer, and the words they are of
        for w in words:
            core, tail = w.lower(), b""
            if b"|" in core and any(c in core for c in control):
                found[w] = self._packed(w.decode())
                continue
            if core[-1:] in tails and core[-2:-1].isalpha():
                core, tail = core[:-1], tails[core[-1:]]
            ids = known.get(core)
            if ids is None:
                t = core.decode()
                if core.isalpha():  # ASCII letters
                    got = map(ID, merged(t))
                elif self.PLAIN.fullmatch(t):
                    t = t.lower()
                    parts = (t,) if t.isalpha() else self.PARTS.findall(t)
                    if not t.isascii():
                        parts = [p.encode().decode("latin-1").translate(self.SIGNS) for p in parts]
                    got = [x.id for p in parts for x in merged(p)]
                else:
                    waiting.setdefault(core, []).append((w, tail))
                    continue
                ids = array("I", got).tobytes()
                if tail:
                    found[core] = ids
            found[w] = ids + tail
        for core in [c for c in waiting if own in c]:
            found.update((w, self._packed(core.decode()) + tail) for w, tail in waiting.pop(core))
        if waiting:
            ids = np.array(self._ids(f" {self.MARK} ".join([c.decode() for c in waiting])), "<u4")
            at = (4 * np.flatnonzero(ids == self.mark)).tolist()
            raw = ids.tobytes()
            for uses, i, j in zip(waiting.values(), [0, *[x + 4 for x in at]], [*at, len(raw)]):
                found.update((w, raw[i:j] + tail) for w, tail in uses)
        return found

    def encode(self, words: list[bytes]) -> bytes:
        return b"".join(self.of(words))

    def encode_texts(self, texts) -> Iterator[bytes]:
        """The ids of every text of an Arrow column (null: none): the distinct words of about ``CHUNK`` bytes are looked up once."""
        import numpy as np
        import pyarrow.compute as pc

        texts = pc.fill_null(texts, "")
        size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < len(texts):
            end = max(first + 1, int(np.searchsorted(size, (size[first - 1] if first else 0) + CHUNK, "right")))
            words = pc.ascii_split_whitespace(texts.slice(first, end - first))
            coded = words.flatten().dictionary_encode()
            which = coded.indices.to_numpy()
            ids = list(self.of(coded.dictionary.cast("binary").to_pylist()))
            count = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
            flat = np.frombuffer(b"".join(ids), "<u4")
            own = count[which]
            upto = np.concatenate([[0], np.cumsum(own)])
            flat = flat[np.repeat((np.cumsum(count) - count)[which] - upto[:-1], own) + np.arange(upto[-1])]
            cuts = upto[words.offsets.to_numpy()].tolist()
            for i, j in zip(cuts, cuts[1:]):
                yield flat[i:j].tobytes()
            first = end


def parted(texts, size: int = CHUNK) -> Iterator[tuple[list[str], list[bytes], "np.ndarray", list[int]]]:
    """Some texts (about ``size`` bytes) of an Arrow column without nulls at a time: the texts, their distinct words, the place there of each
    word in order, and the first word of every text, with the end."""
    import numpy as np
    import pyarrow.compute as pc

    upto = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        end = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + size, "right")))
        some = texts.slice(first, end - first)
        words = pc.ascii_split_whitespace(some)
        cuts, flat = words.offsets.to_numpy(), words.flatten()
        real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)  # white space at a text's ends leaves empty words
        if not real.all():
            cuts, flat = np.concatenate([[0], np.cumsum(real)])[cuts], flat.filter(real)
        coded = flat.dictionary_encode()
        yield some.to_pylist(), coded.dictionary.cast("binary").to_pylist(), coded.indices.to_numpy(), cuts.tolist()
        first = end


def word_tokens(name: str) -> WordTokens:
    return process_wide(("words", name), lambda: WordTokens(vocabulary(name)))


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file, looked up where the task runs."""
    import public_tokenizers

    return public_tokenizers.path(name)
