"""Whole texts to token ids with a tokenizer file, word by word.

The tokenizer drops white space and never joins across it, so the ids of a text are the ids of its
white-space separated words in order.  Words repeat, so each worker keeps the ids of words it has
met.  The kept words are bounded: beyond ``MAX_WORDS`` the newer half is forgotten, which costs time only.
"""

from __future__ import annotations

import operator
import os
import re
from functools import lru_cache
from itertools import islice, repeat

import numpy as np
import pyarrow as pa

#: Kept words of one worker, about 200 bytes each, and the longest word that is kept.
MAX_WORDS = 300_000
MAX_WORD_BYTES = 64
#: ASCII punctuation that never joins a letter before it; no apostrophe, which starts endings like 's.
CLOSING = b".,;:!?#%&*$|\")]"
#: New words that the tokenizer gets at once.
CHUNK_WORDS = 1500
#: Small letters of ASCII and Latin-1, which normalisation leaves as they are.
PLAIN = re.compile("(?:[a-z]|\u00c3[\u009f-\u00b6\u00b8-\u00bf])+".encode("latin-1")).fullmatch


def _kind(byte: int) -> int:
    """What a byte is to the question whether a comma or full stop may be cut off behind it."""
    char = chr(byte)
    if char in ".,":
        return ord(".")
    if char in " \t\n\r\x0b\x0c" or "a" <= char <= "z" or "0" <= char <= "9":
        return ord("a")
    if byte == 0xC3:
        return ord("c")  # with what follows a letter of Latin-1, or one of two signs
    return ord("h") if 0x80 <= byte <= 0xBF and byte not in (0x97, 0xB7) else ord("!")


KINDS = bytes(map(_kind, range(256)))


def _prepared(text: bytes) -> bytes:
    """``text`` with the same ids but fewer different words.

    Lower case, and a blank before commas and full stops: a letter or digit before them is a word of its
    own anyhow.  Texts that might hold special tokens, and those with other signs before commas or
    full stops, stay as they are.
    """
    if b"<|" in text:
        return text
    text = text.lower()
    kinds = text.translate(KINDS)
    if b"!." in kinds or b".." in kinds or b"c." in kinds or kinds.count(b"h.") != kinds.count(b"ch."):
        return text
    return text.replace(b",", b" ,").replace(b".", b" .")


class WordEncoder:
    """Encodes UTF-8 texts; the ids come back as little-endian unsigned 32-bit integers.

    Only for tokenizers that lower-case, discard white space and split words from punctuation.  Strings
    that look like special tokens are handled as the tokenizer file says, as they would be in the whole text.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.mark, self.mark_id = self._separator()
        self.whole = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        self.plain = normalizers.Sequence([]), pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _separator(self) -> tuple[bytes, int]:
        """A character that is one token, to tell words apart that are encoded in one call."""
        for mark in "★☆♥♫✓✿":
            ids = self.tokenizer.encode(mark, add_special_tokens=False).ids
            if len(ids) == 1:
                return mark.encode(), ids[0]
        raise ValueError("the tokenizer has no single token for any of the separators")

    def _alone(self, word: bytes) -> bytes:
        ids = self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _learn(self, words: list[bytes]) -> None:
        letters, mixed, alone = [], [], []
        for word in words:
            if PLAIN(word):
                letters.append(word)
            elif self.mark in word or b"<|" in word or len(word) > MAX_WORD_BYTES:
                alone.append(word)
            else:
                mixed.append(word)
        self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.plain
        for i in range(0, len(letters), CHUNK_WORDS):
            self._learn_letters(letters[i : i + CHUNK_WORDS])
        self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.whole
        for i in range(0, len(mixed), CHUNK_WORDS):
            self._learn_joined(mixed[i : i + CHUNK_WORDS])
        for word in alone:
            self.known[word] = self._alone(word)

    def _learn_letters(self, words: list[bytes]) -> None:
        """Words of small letters are one unit each, and a unit's last token is marked as such."""
        (found,) = self.tokenizer.encode_batch_fast([b" ".join(words).decode()], add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        ends = 4 * (np.flatnonzero(self.closes[ids]) + 1)
        self._keep(words, ids.tobytes(), [0, *ends[:-1].tolist()], ends.tolist())

    def _learn_joined(self, words: list[bytes]) -> None:
        text = (b" " + self.mark + b" ").join(words).decode("utf-8", "replace")
        (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        marks = 4 * np.flatnonzero(ids == self.mark_id)
        self._keep(words, ids.tobytes(), [0, *(marks + 4).tolist()], [*marks.tolist(), 4 * len(ids)])

    def _keep(self, words: list[bytes], ids: bytes, starts: list[int], ends: list[int]) -> None:
        if len(ends) == len(words):
            self.known.update((word, ids[i:j]) for word, i, j in zip(words, starts, ends))
        else:  # a tokenizer of another kind: still right, only slow
            self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.whole
            self.known.update((word, self._alone(word)) for word in words)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text."""
        split = [_prepared(t).split() for t in texts]  # white space of ASCII only, which every tokenizer agrees on
        if len(self.known) > MAX_WORDS:
            # Frequent words were met early: the older half stays.
            self.known = dict(islice(self.known.items(), MAX_WORDS // 2))
        known = self.known
        fresh = list(set().union(*split).difference(known))
        # In lower case, closing punctuation apart: the tokenizer separates both as well.  What might
        # hold a special token, whose letters keep their case, stays as it is.
        low = [w if b"<|" in w else w.lower() for w in fresh]
        stems = [w.rstrip(CLOSING) for w in low]
        stems = [s if len(s) < len(w) and s[-1:].isalpha() and b"<|" not in w else w for s, w in zip(stems, low)]
        tails = [w[len(s) :] for s, w in zip(stems, low)]
        new = {*stems, *tails}.difference(known)
        new.discard(b"")
        self._learn(list(new))
        known[b""] = b""
        known.update(zip(fresh, map(operator.add, map(known.__getitem__, stems), map(known.__getitem__, tails))))
        out = [b"".join(operator.itemgetter(b"", *words, b"")(known)) for words in split]
        for word in [w for w in new.union(fresh) if len(w) > MAX_WORD_BYTES]:
            del known[word]
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder per worker and file."""
    return WordEncoder(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Bytes of text that are split into words at once.
GROUP_BYTES = 2 << 20


def encoded(batches, path: str):
    """(doc_id, its Arrow type, ids) of every row of Arrow batches with columns ``doc_id`` and ``text`` (binary), in order.

    A batch is let go before the next one is read.
    """
    encode = encoder(path).encode
    for batch in batches:
        texts, doc_ids = batch.column("text"), batch.column("doc_id")
        del batch
        rows, start, size = len(texts), 0, 0
        for row in range(rows):
            size += len(texts[row].as_buffer() or b"")
            if size >= GROUP_BYTES or row == rows - 1:
                group = [t or b"" for t in texts.slice(start, row + 1 - start).to_pylist()]
                ids = encode(group)
                del group
                yield from zip(doc_ids.slice(start, row + 1 - start).to_pylist(), repeat(doc_ids.type), ids)
                start, size = row + 1, 0
        del texts, doc_ids
        pa.default_memory_pool().release_unused()
