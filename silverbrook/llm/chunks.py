"""Texts cut where a tokenizer must end a token, so that repeated pieces are encoded once."""

from __future__ import annotations

import json
import os
import re
import string
from collections.abc import Callable, Iterable, Iterator
from itertools import islice
from operator import attrgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

# Fixed value: white space but the plain space, as the tokenizers' split patterns know it.
_OTHER = "\t-\r\x85\xa0  -     　"
_ANY = f" {_OTHER}"
# A chunk ends before a space that follows anything but white space. Split patterns of byte-level
# vocabularies never match across such a place, nor do pieces that hold the space mark inside.
_CHUNK = re.compile(
    f"(?: [{_ANY}]*[^{_ANY}]*|[^{_ANY}]+|[{_OTHER}][{_ANY}]*[^{_ANY}]*)(?:[{_OTHER}][{_ANY}]*[^{_ANY}]*)*")
_UNEVEN = re.compile(f"[{_ANY}] ")
_BLANKS = re.compile(f"[{_ANY}][{_ANY}]")
GROUP = 1 << 20  # characters of texts that are looked at together
WIDE = 1 << 22  # characters of texts that are cut together by their bytes
# Fixed value: letters to every version of Unicode that a library may know.
_WORD = re.compile(" ?[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f]+").fullmatch
# Kinds of bytes; the last three are white space.
_LEAD, _LETTER, _MARK, _QUOTE, _SPACE, _BREAK, _BLANK = range(1, 8)
# Fixed value: the white space outside ASCII, in UTF-8.
_FAR = np.array([int.from_bytes(c.encode().ljust(3, b"\0")) for c in map(chr, range(128, 0x3001)) if c.isspace()])
NEXT = "\ud800"  # no text in UTF-8 holds it

# A chunk goes by what follows its space; one that begins a text without a space is in a tuple, and one
# that begins at a line break follows NEXT.
Key = str | tuple[str]


def written(key: Key) -> str:
    """The chunk of a key."""
    if isinstance(key, tuple):
        return key[0]
    return key[1:] if key[:1] == NEXT else " " + key


def _key(chunk: str) -> Key:
    return chunk[1:] if chunk[0] == " " else (chunk,)


def chunks(text: str, breaks: bool = False) -> Iterator[list[Key]]:
    """Keys of the chunks of a text in order, in lists of bounded length; joined the chunks are the text.

    With ``breaks``, a line break between two other characters than white space is a chunk of its own, so
    that the words beside it are known from elsewhere.
    """
    single = breaks and "\n" in text and text[-1] != "\n" and len(text) <= GROUP and not _BLANKS.search(text)
    if single:
        text = text.replace("\n", f" {NEXT}\n {NEXT}")
    elif len(text) > GROUP:
        found = (_key(m[0]) for m in _CHUNK.finditer(text))
        yield from iter(lambda: list(islice(found, GROUP >> 3)), [])
        return
    elif _UNEVEN.search(text):
        yield [_key(c) for c in _CHUNK.findall(text)]
        return
    if text:  # no space follows white space but for breaks, so that every space begins a chunk
        keys: list[Key] = text.split(" ")  # type: ignore[assignment]
        if keys[0]:
            keys[0] = (keys[0],)
        else:
            del keys[0]
        yield keys


def groups(texts: Iterable[str], breaks: bool = False) -> Iterator[list[tuple[int, list[Key]]]]:
    """Chunks of texts with the text's number, about GROUP characters at a time."""
    group, held = [], 0
    for i, text in enumerate(texts):
        for part in chunks(text, breaks):
            group.append((i, part))
            held += min(len(text), GROUP)
            if held >= GROUP:
                yield group
                group, held = [], 0
    if group:
        yield group


def kinds(marks: Iterable[str]) -> np.ndarray:
    """The kind of each byte, given the marks that part words."""
    out = np.zeros(256, dtype=np.uint8)
    out[list(b"\t\v\f\r")] = _BLANK
    out[[0xC2, 0xE1, 0xE2, 0xE3]] = _LEAD
    for signs, kind in ((string.ascii_letters, _LETTER), ("".join(marks), _MARK), ("'", _QUOTE), (" ", _SPACE), ("\n", _BREAK)):
        out[list(signs.encode())] = kind
    return out


def cut(raw: list[bytes], kind_of: np.ndarray) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    """Chunks of texts in order, the number of them in each text, and which texts were left out.

    Split patterns of byte-level vocabularies end a match before a space that follows anything but white
    space, on both sides of a line break between two other characters, and between a letter and a mark or
    digit, but for what follows an apostrophe. Texts with white space outside ASCII are left out.
    """
    sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    kind = kind_of[data]
    leads = np.flatnonzero(kind == _LEAD)
    codes = np.zeros(len(leads), dtype=np.int64)
    for k in range(3):
        held = data[np.minimum(leads + k, len(data) - 1)].astype(np.int64)
        codes = codes << 8 | (held if k < 2 else np.where(data[leads] == 0xC2, 0, held))
    far = np.zeros(len(raw), dtype=bool)
    far[np.searchsorted(np.cumsum(sizes), leads[np.isin(codes, _FAR)], side="right")] = True
    if far.any():
        kept = ~np.repeat(far, sizes)
        data, kind = data[kept], kind[kept]
        sizes[far] = 0
    size = len(data)
    at = np.zeros(size + 1, dtype=bool)
    if size > 1:
        before, here, dark = kind[:-1], kind[1:], kind < _SPACE
        at[1:-1] = (here == _SPACE) & dark[:-1]
        at[1:-1] |= (before == _LETTER) & ((here == _MARK) | (here == _QUOTE))
        at[1:-1] |= (before == _MARK) & (here == _LETTER)
        breaks = np.flatnonzero(kind[1:-1] == _BREAK) + 1
        breaks = breaks[dark[breaks - 1] & dark[breaks + 1]]
        at[breaks] = at[breaks + 1] = True
    ends = np.cumsum(sizes)
    at[0] = at[ends] = True
    places = np.flatnonzero(at).astype(np.int32)
    found = pa.StringArray.from_buffers(len(places) - 1, pa.py_buffer(places), pa.py_buffer(data))
    return found, np.diff(np.searchsorted(places, ends), prepend=0), far


class Remembered:
    """What ``make`` gives for each chunk, remembered within a bound of bytes.

    Two generations of about ``limit`` bytes each: when the newer one is full it becomes the older, and
    what is asked for again moves back, so chunks that recur often are never made anew.
    """

    def __init__(self, make: Callable[[list[Key]], Iterable], cost: Callable[[object], int], limit: int = 128 << 20,
                 breaks: bool = False):
        self.make, self.cost, self.limit, self.breaks = make, cost, limit, breaks
        self.known: dict[Key, object] = {}
        self.older: dict[Key, object] = {}
        self.held = 0

    def _learn(self, wanted: set[Key]) -> dict[Key, object]:
        if self.held > self.limit:
            self.known, self.older, self.held = {}, self.known, 0
        older = self.older  # far more keys than are wanted, which are looked up
        new = {key: older[key] for key in wanted if key in older}
        unknown = list(wanted.difference(new))
        new.update(zip(unknown, self.make(unknown), strict=True))
        self.known.update(new)
        self.held += 200 * len(new) + 2 * sum(map(len, new)) + sum(map(self.cost, new.values()))
        return new

    def each(self, keys: list[Key]) -> list:
        """Results of distinct chunks."""
        out = list(map(self.known.get, keys))
        places = [at for at, result in enumerate(out) if result is None]
        new = self._learn({keys[at] for at in places}) if places else {}
        for at in places:
            out[at] = new[keys[at]]
        return out

    def of(self, texts: Iterable[str]) -> Iterator[tuple[int, list]]:
        """(number of the text, results of its chunks), in order; a long text comes in several parts.

        Results are never None, which marks the places of chunks that are not known yet.
        """
        for group in groups(texts, self.breaks):
            get = self.known.get
            found = [list(map(get, part)) for _, part in group]
            gaps = list(map(_gaps, found))
            wanted = {part[at] for (_, part), places in zip(group, gaps, strict=True) for at in places}
            new = self._learn(wanted) if wanted else {}
            for (i, part), out, places in zip(group, found, gaps, strict=True):
                for at in places:
                    out[at] = new[part[at]]
                yield i, out


def _gaps(found: list) -> list[int]:
    """Places of None in a list."""
    places, at = [], -1
    try:
        while True:
            at = found.index(None, at + 1)
            places.append(at)
    except ValueError:
        return places


class ByteLevel:
    """A byte-level vocabulary of the tokenizers library, with the bytes of its tokens."""

    def __init__(self, name: str, plain_specials: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(public_tokenizers.path(name))
        self.library.encode_special_tokens = plain_specials
        # Chunks that recur don't reach the library, so its own memory of words costs more than it gives.
        self.library.model._resize_cache(0)
        # The pattern of such a vocabulary parts a single line break from what is beside it.
        split = json.loads(self.library.to_str())["pre_tokenizer"] or {}
        self.breaks = split.get("type") == "ByteLevel" and bool(split.get("use_regex"))
        # Whole tokens that the library looks for first are cut nowhere, and none of them is in a word.
        added = self.library.get_added_tokens_decoder().values()
        inside = "".join(t.content for t in added)
        self.even = self.breaks and not split.get("add_prefix_space") and self.library.normalizer is None and all(
            not (t.lstrip or t.rstrip or t.single_word or _WORD(t.content) or any(map(str.isspace, t.content)))
            for t in added)
        self.kinds = kinds(c for c in string.digits + string.punctuation if c != "'" and c not in inside)
        self.model = self.library.model
        # Printable bytes stand for themselves in such a vocabulary, the others for the
        # characters from 256 on.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [x for x in range(256) if x not in own]
        of_char = {chr(x): x for x in own} | {chr(256 + k): x for k, x in enumerate(rest)}
        self.bytes = {i: bytes(of_char[c] for c in token) if all(c in of_char for c in token) else token.encode()
                      for token, i in self.library.get_vocab().items()}
        self.sizes = np.zeros(max(self.bytes) + 1, dtype=np.int64)
        self.sizes[list(self.bytes)] = list(map(len, self.bytes.values()))
        self.char_of = {byte: char for char, byte in of_char.items() if chr(byte) != char}

    def _of_words(self, words: list[str]) -> list[bytes]:
        """Ids of words that the library's pattern leaves whole, by the library's model."""
        tokenize, number, char_of, ids, ends = self.model.tokenize, attrgetter("id"), self.char_of, [], []
        for word in words:
            if word.isascii():
                word = word.replace(" ", char_of[32])
            else:
                word = word.encode().decode("latin-1").translate(char_of)
            ids.extend(map(number, tokenize(word)))
            ends.append(4 * len(ids))
        raw = np.array(ids, dtype="<u4").tobytes()
        return [raw[begin:end] for begin, end in zip([0, *ends], ends)]

    def of_chunks(self, keys: list[Key], together: int = 1000) -> list[bytes]:
        """Ids of the chunk of each key."""
        return self.of_parts(list(map(written, keys)), together)

    def of_parts(self, parts: list[str], together: int = 1000) -> list[bytes]:
        """Ids of each chunk, as little-endian 32-bit integers.

        Words go to the library's model, as its pattern leaves them whole.
        """
        words = [k for k, p in enumerate(parts) if _WORD(p)] if self.even else []
        if not words:
            return self._of_runs(parts, together)
        out: list[bytes] = [b""] * len(parts)
        for k, ids in zip(words, self._of_words([parts[k] for k in words]), strict=True):
            out[k] = ids
        others = [k for k, ids in enumerate(out) if not ids]
        for k, ids in zip(others, self._of_runs([parts[k] for k in others], together), strict=True):
            out[k] = ids
        return out

    def _of_runs(self, parts: list[str], together: int) -> list[bytes]:
        """Ids of any chunks, by the whole library.

        Chunks that may follow each other are given to the library as one text and cut by their bytes. Where a
        single line break is a token, those without a space follow one, and its id is left out.
        """
        out: list[bytes] = [b""] * len(parts)
        apart = [k for k, p in enumerate(parts) if p[0] != " " or p[-1].isspace()]
        after = {k for k in apart if not (parts[k][0].isspace() or parts[k][-1].isspace())} if self.breaks else set()
        alone = [k for k in apart if k not in after]
        rest = set(apart)
        whole = [k for k in range(len(parts)) if k not in rest] if apart else range(len(parts))
        begun = sorted(after)
        runs, held, lead = [], [], []
        for some in (whole, begun):
            for at in range(0, len(some), together):
                runs.append(some[at : at + together])
                texts = [parts[k] for k in runs[-1]]
                held.append(["\n" + p for p in texts] if some is begun else texts)
                lead.append(4 if some is begun else 0)
        runs += [[k] for k in alone]
        held += [[parts[k]] for k in alone]
        lead += [0] * len(alone)
        found = self.library.encode_batch_fast(list(map("".join, held)), add_special_tokens=False)
        for run, texts, made, skip in zip(runs, held, found, lead, strict=True):
            ids = np.array(made.ids, dtype="<u4")
            ends = np.cumsum(self.sizes[ids])
            cuts = np.cumsum(list(map(len, map(str.encode, texts))))
            at = np.searchsorted(ends, cuts)
            if not np.array_equal(ends[at], cuts):
                raise ValueError("a token crosses a place where the tokenizer has to end one")
            raw, stops = ids.tobytes(), (4 * at + 4).tolist()
            for k, begin, end in zip(run, [0, *stops], stops):
                out[k] = raw[begin + skip : end]
        return out
