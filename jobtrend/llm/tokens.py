"""Token ids of whole texts, with a worker-wide cache of words.

Byte-level BPE cuts a text into words by a fixed pattern and never joins characters across words. Where
words begin follows from classes of characters (letter, number, white space, other), so it is computed
for all texts of a call at once with numpy; Arrow numbers the different words of the call, each is looked
up once, and only new ones reach the model. Words are kept in two generations: when the younger is full it
becomes the older, and what is used again moves back, so frequent words stay and memory is bounded.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from jobtrend.llm.common import process_cache, utf8_buffer

END_OF_TEXT = 2
#: Rows and bytes of text that are encoded in one call.
CALL = (1 << 16, 1 << 21)
#: Words of one generation (about 200 bytes each), and the longest that are kept (bytes).
KEPT_WORDS, KEPT_LENGTH = 300_000, 64
#: Texts of more bytes are encoded in parts of about so many, cut at spaces inside of which no word lies.
PART = 1 << 22
#: White space of the word pattern, and the endings that the pattern keeps with their apostrophe.
WHITE_SPACE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ENDINGS = ("s", "t", "m", "d", "re", "ve", "ll")
OTHER, LETTER, NUMBER, SPACE, UNKNOWN = range(5)


def byte_symbols() -> list[str]:
    """The character that a byte-level vocabulary writes for each byte."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def character_classes() -> np.ndarray:
    """The class of each code point; UNKNOWN for those that this Python's Unicode tables do not have."""
    kept = process_cache()
    if "classes" not in kept:
        kind = {"L": LETTER, "N": NUMBER}
        of = {}
        table = np.empty(0x110000, np.uint8)
        for k in range(0x110000):
            category = unicodedata.category(chr(k))
            if category not in of:
                of[category] = UNKNOWN if category == "Cn" else kind.get(category[0], OTHER)
            table[k] = of[category]
        table[WHITE_SPACE] = SPACE
        kept["classes"] = table
    return kept["classes"]


def word_starts(points: np.ndarray, classes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Which code points begin a word; ``begins`` are those that begin a (non-empty) text."""
    n = len(points)
    space = classes == SPACE
    blank = points == 0x20
    edge = np.zeros(n + 1, bool)
    edge[begins] = edge[n] = True
    start = edge[:-1].copy()
    start[1:] |= classes[1:] != classes[:-1]
    follows = np.zeros(n, bool)  # characters that are no space, right behind a blank of their text
    follows[1:] = ~space[1:] & blank[:-1]
    start[follows & ~edge[:-1]] = False
    last = np.zeros(n, bool)  # of a run of white space that something follows
    last[:-1] = space[:-1] & ~space[1:] & ~edge[1:-1]
    start |= last
    quotes = np.flatnonzero((points == 0x27) & start)
    ahead = np.zeros((len(quotes), 2), np.uint32)
    whole = quotes + 1 < n
    whole[whole] &= ~edge[quotes[whole] + 1]
    ahead[whole, 0] = points[quotes[whole] + 1]
    whole &= quotes + 2 < n
    whole[whole] &= ~edge[quotes[whole] + 2]
    ahead[whole, 1] = points[quotes[whole] + 2]
    for ending in ENDINGS:
        found = quotes[(ahead[:, : len(ending)] == [ord(c) for c in ending]).all(axis=1)]
        start[found + 1] = False
        after = found + len(ending) + 1
        start[after[after < n]] = True
    return start


class Kept:
    """A dictionary of two generations with at most ``entries`` each."""

    def __init__(self, entries: int):
        self.entries = entries
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def find(self, keys: list[bytes], make: Callable[[list[bytes]], list[bytes]]) -> list[bytes]:
        """The value of each key; missing ones are made together, and kept if they are short."""
        found = list(map(self.young.get, keys))
        missing = [k for k, value in enumerate(found) if value is None]
        again = list(map(self.old.get, [keys[k] for k in missing]))
        fresh = [keys[k] for k, value in zip(missing, again) if value is None]
        made = iter(make(fresh) if fresh else ())
        for k, value in zip(missing, again):
            if value is None:
                value = next(made)
            found[k] = value
            key = keys[k]
            if len(key) <= KEPT_LENGTH:
                if len(self.young) >= self.entries:
                    self.old, self.young = self.young, {}
                self.young[key] = value
        return found


def values_of(ids: list[list[int]]) -> list[bytes]:
    """Each list as int32 bytes."""
    ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))) * 4
    flat = np.fromiter(chain.from_iterable(ids), np.int32, int(ends[-1]) // 4 if len(ends) else 0).tobytes()
    return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def gathered(values: list[bytes], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of ``values[k]`` for each k in ``at``, back to back, and where each begins (one more at the end)."""
    size = np.fromiter(map(len, values), np.int64, len(values)) // 4
    begin = (np.cumsum(size) - size)[at]
    ids = np.frombuffer(b"".join(values), np.int32)
    size = size[at]
    begins = np.concatenate([[0], np.cumsum(size)])
    return ids[np.arange(begins[-1]) + np.repeat(begin - begins[:-1], size)], begins


class TextEncoder:
    """Ids of texts, equal to encoding each whole text.

    ``word_ids`` gives the ids of words that are written in byte symbols. ``special`` are texts with an id of their
    own; ``split`` cuts a text whose characters this Python's Unicode tables do not know.
    """

    def __init__(self, word_ids: Callable[[list[str]], list[list[int]]], special: dict[str, int], split: Callable[[str], list[str]]):
        self.word_ids, self.special, self.split = word_ids, special, split
        self.symbols = str.maketrans({chr(b): x for b, x in enumerate(byte_symbols())})
        self.kept = Kept(KEPT_WORDS)
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.cut_at = re.compile("(?<=[0-9A-Za-z]) (?=[0-9A-Za-z])")

    def _new_words(self, words: list[bytes]) -> list[bytes]:
        return values_of(self.word_ids([w.decode("latin-1").translate(self.symbols) for w in words]))

    def _plain(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, where each text's begin, and which texts hold unknown characters (their ids are wrong)."""
        text = data.tobytes()
        points = np.frombuffer(text.decode().encode("utf-32-le"), np.uint32)
        classes = character_classes()[points]
        place = np.flatnonzero((data & 0xC0) != 0x80) if len(points) < len(data) else np.arange(len(data))
        begins = np.searchsorted(place, offsets)
        start = place[word_starts(points, classes, begins[:-1][np.diff(offsets) > 0])]
        unknown = np.zeros(len(offsets) - 1, bool)
        odd = np.flatnonzero(classes == UNKNOWN)
        if len(odd):
            unknown[np.searchsorted(begins, odd, side="right") - 1] = True
        bounds = np.append(start, len(data))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(text)]).dictionary_encode()
        ids, at = gathered(self.kept.find(words.dictionary.to_pylist(), self._new_words), words.indices.to_numpy())
        return ids, at[np.searchsorted(start, offsets)], unknown

    def _odd(self, text: str) -> np.ndarray:
        """Any text: special ones apart, long ones in parts, unknown characters as ``split`` has them."""
        if self.at_special is not None:
            parts = self.at_special.split(text)
            if len(parts) > 1:
                return np.concatenate([np.array([self.special[x]], np.int32) if k % 2 else self._odd(x) for k, x in enumerate(parts)])
        out, at = [], 0
        while at < len(text):
            cut = self.cut_at.search(text, at + PART)
            part = text[at : cut.start() if cut else len(text)]
            at += len(part)
            data = np.frombuffer(part.encode(), np.uint8)
            ids, _, unknown = self._plain(data, np.array([0, len(data)]))
            if unknown[0]:
                ids = np.frombuffer(b"".join(self.kept.find([w.encode() for w in self.split(part)], self._new_words)), np.int32)
            out.append(ids)
        return np.concatenate([*out, np.empty(0, np.int32)])

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids back to back (int32), and where each text's begin (one more at the end). Null is empty."""
        texts = texts.cast(pa.large_string()).fill_null("")
        odd = pc.greater(pc.binary_length(texts), PART)
        for x in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, x))
        usual = pc.if_else(odd, "", texts) if pc.any(odd).as_py() else texts
        ids, begins, unknown = self._plain(*utf8_buffer(usual))
        odd = odd.to_numpy(zero_copy_only=False) | unknown
        if odd.any():
            found = [self._odd(texts[k].as_py()) if x else ids[begins[k] : begins[k + 1]] for k, x in enumerate(odd)]
            ids, begins = np.concatenate(found), np.cumsum([0, *map(len, found)])
        return ids, begins

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as int32."""
        ids, begins = self.encode_column(pa.array(texts, pa.large_string()))
        return [ids[a:b] for a, b in zip(begins, begins[1:])]


class WholeEncoder(TextEncoder):
    """Ids of texts for any tokenizer file: every text is given to the library whole."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [np.array(x.ids, np.int32) for x in self.tokenizer.encode_batch_fast([x or "" for x in texts.to_pylist()], add_special_tokens=False)]
        return np.concatenate([*found, np.empty(0, np.int32)]), np.cumsum([0, *map(len, found)])


def with_end(ids: np.ndarray, begins: np.ndarray, end: int = END_OF_TEXT) -> tuple[np.ndarray, np.ndarray]:
    """The same with an end id behind each text."""
    return np.insert(ids, begins[1:], end), begins + np.arange(len(begins))


def is_byte_level(described: dict) -> bool:
    """Whether a tokenizer file is a plain byte-level BPE with GPT-2's word pattern."""
    before, model = described.get("pre_tokenizer") or {}, described["model"]
    plain = not any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    added = all(not (x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"]) for x in described.get("added_tokens", []))
    usual = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and bool(before.get("use_regex", True))
    return plain and added and usual and described.get("normalizer") is None and model.get("type") == "BPE"


def encoder(path: str, special: bool = True) -> TextEncoder:
    """This worker's encoder for a file of the tokenizers library.

    ``special``: texts of added tokens get their ids; else they are ordinary text.
    """
    kept = process_cache()
    key = "encoder", path, special
    if key not in kept:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker a core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        tokenizer.encode_special_tokens = not special
        if is_byte_level(json.loads(tokenizer.to_str())):
            model, before = tokenizer.model, tokenizer.pre_tokenizer
            added = {x.content: k for k, x in tokenizer.get_added_tokens_decoder().items()} if special else {}
            kept[key] = TextEncoder(
                lambda words: [[x.id for x in model.tokenize(w)] for w in words], added, lambda text: [text[a:b] for _, (a, b) in before.pre_tokenize_str(text)]
            )
        else:
            kept[key] = WholeEncoder(tokenizer)
    return kept[key]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
