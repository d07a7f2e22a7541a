"""Token ids with a public tokenizer, by the piece: white-space units repeat, so each unit of a batch is encoded once.

No token spans from a word into the white space behind it, and normalisation does not either. A text's ids are therefore
those of its units: a run of white space with the word behind it, or a last run. Strings of special tokens hold no white
space, so they are found inside their units as in the whole text.

Arrow splits a batch, finds its distinct units and puts their ids in the texts' places; only distinct pieces meet Python.
"""

from __future__ import annotations

import os
import re
import string
import sys
from array import array
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from mediameta.llm.common import keep

# The characters that tokenizers count as white space.
WHITE = "\t-\r \x85\xa0  -     　"
UNIT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
UNIT_END = re.compile(f"[^{WHITE}][{WHITE}]")
# A space behind other white space, or at a text's end, is no beginning of a unit.
RUN = rf"[{WHITE}] | \z"
#: Longer texts are cut into parts of so many characters.
PART = 1 << 20
#: Bytes of texts that are encoded together.
TOGETHER = 1 << 24
#: Pieces, and units of other kinds, remembered per worker: the first so many, as frequent ones come early.
REMEMBERED = 50_000


def load(tokenizer: str):
    """The tokenizer in this file, or the public one of this name."""
    # Units are short: a thread each costs more than it gives, and Spark's tasks have the cores already.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    if not os.path.exists(tokenizer):
        import public_tokenizers

        tokenizer = public_tokenizers.path(tokenizer)
    return Tokenizer.from_file(tokenizer)


def parts(text: str) -> Iterator[str]:
    """About ``PART`` characters at a time; a part ends where a word does."""
    at = 0
    while at < len(text):
        end = at + PART
        if end < len(text):
            found = UNIT_END.search(text, end - 1)
            end = found.start() + 1 if found else len(text)
        yield text[at:end]
        at = end


def little_endian(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def joined(values: pa.Array, stops: np.ndarray) -> pa.Array:
    """Binary values joined to one per stop: those before the first stop, those from there to the second, ..."""
    if not len(values):
        return pa.array([b""] * len(stops), pa.binary())
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int32)[values.offset : values.offset + len(values) + 1]
    return pa.Array.from_buffers(pa.binary(), len(stops), [None, pa.py_buffer(at[np.r_[0, stops]]), data or pa.py_buffer(b"")])


def merged(mask: np.ndarray, yes: pa.Array, no: pa.Array) -> pa.Array:
    """The values of ``yes`` where the mask is set and those of ``no`` elsewhere, each in order."""
    if mask.all():
        return yes
    return pa.concat_arrays([yes, no]).take(pa.array(np.where(mask, np.cumsum(mask) - 1, len(yes) + np.cumsum(~mask) - 1)))


def looked_up(memory: dict[str, bytes], keys: pa.Array) -> pa.Array:
    """What the memory has, or finds, for these keys; few of them are Python's at a time."""
    ids, sizes = bytearray(), array("i")
    for at in range(0, len(keys), REMEMBERED):
        found = [memory[k] for k in keys.slice(at, REMEMBERED).to_pylist()]
        ids += b"".join(found)
        sizes.extend(map(len, found))
    stops = np.r_[0, np.cumsum(sizes, dtype=np.int32)].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(stops), pa.py_buffer(bytes(ids))])


# Letters of Latin-1 that words are of: ordinals and the micro sign are not, and an apostrophe would make other pieces.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
# Marks that stand behind a word.
MARKS = re.escape(string.punctuation)
# A plain unit: Latin letters behind a space, a line end or nothing, and marks.
PLAIN = rf"\A(?P<white>[ \n]?)(?P<word>[{LETTERS}]+)(?P<marks>[{MARKS}]*)\z"
# What can stand inside a plain unit.
INSIDE = re.compile(rf"[ \n]?[{LETTERS}]*[{MARKS}]*")
# Texts on which the short way must agree with the whole tokenizer, or it is not taken.
PROBES = ["the", " The", " Straße,", "ÉTÉ", " a", "Wort.", "\nnaïve?!", "\nHeLLo...", "x;", "œuvre", " Ünïcödé", " qzx", "tionen", " so.\")", "\nwho'\"?!", " a***$$$"]
PROBES += [f" a{c * n}" for c in string.punctuation for n in (1, 2, 3, 4)]


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 ones themselves, then from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Pieces(dict):
    """Ids of pieces by the model's merges alone."""

    def __init__(self, merges) -> None:
        self.merges, self.letters = merges, byte_letters()

    def named(self, piece: str) -> str:
        return piece.replace(" ", self.letters[32]) if piece.isascii() and piece != "\n" else piece.encode().decode("latin1").translate(self.letters)

    def __missing__(self, piece: str) -> bytes:
        ids = little_endian([t.id for t in self.merges.tokenize(self.named(piece))])
        if len(self) < REMEMBERED:
            self[piece] = ids
        return ids

    def of(self, pieces: pa.Array) -> pa.Array:
        coded = pieces.dictionary_encode()
        return looked_up(self, coded.dictionary).take(coded.indices)


class Units(dict):
    """Ids of units. Plain ones go a short way, without a pass through normaliser and splitter, if there is one.

    The short way is tried in the two forms of byte-level models, with the white space before a word and without white space and upper
    case, and taken if it gives the tokenizer's ids on all probes and no added token can stand inside a plain unit.
    """

    def __init__(self, model) -> None:
        self.model = model
        self.pieces = Pieces(model.model)
        added = any(INSIDE.fullmatch(t.content) for t in model.get_added_tokens_decoder().values())
        self.form = None if added else next((f for f in (self.spaced, self.lowered) if self.agrees(f)), None)

    def spaced(self, white: pa.Array, word: pa.Array, marks: pa.Array) -> pa.Array:
        line = pc.equal(white, "\n")
        lead, white = pc.if_else(line, white, ""), pc.if_else(line, "", white)
        return self.one_behind_another(lead, pc.binary_join_element_wise(white, word, ""), marks)

    def lowered(self, white: pa.Array, word: pa.Array, marks: pa.Array) -> pa.Array:
        return self.one_behind_another(pc.utf8_lower(word), marks)

    def one_behind_another(self, *pieces: pa.Array) -> pa.Array:
        return pc.binary_join_element_wise(*[self.pieces.of(p) for p in pieces], b"")

    def agrees(self, form: Callable[[pa.Array, pa.Array, pa.Array], pa.Array]) -> bool:
        probes = pa.array(PROBES)
        found = pc.extract_regex(probes, PLAIN)
        try:
            return form(*found.drop_null().flatten()).to_pylist() == [self.whole(p) for p in probes.filter(found.is_valid()).to_pylist()]
        except Exception:  # noqa: BLE001  a model of another kind
            return False

    def whole(self, unit: str) -> bytes:
        return little_endian(self.model.encode(unit, add_special_tokens=False).ids)

    def __missing__(self, unit: str) -> bytes:
        ids = self.whole(unit)
        if len(self) < REMEMBERED:
            self[unit] = ids
        return ids

    def of(self, units: pa.Array) -> pa.Array:
        """Ids of distinct units."""
        if not self.form:
            return self.others(units)
        found = pc.extract_regex(units, PLAIN)
        plain = found.is_valid()
        mask = plain.to_numpy(zero_copy_only=False)
        return merged(mask, self.form(*found.filter(plain).flatten()), self.others(units.filter(pc.invert(plain))))

    def others(self, units: pa.Array) -> pa.Array:
        return looked_up(self, units)


class Words:
    """Ids of texts, by their distinct units."""

    def __init__(self, model) -> None:
        self.units = Units(model)

    def encode(self, text: str) -> bytes:
        rest, out = parts(text), []
        while some := list(islice(rest, max(1, TOGETHER // PART))):
            out += self.together(pa.array(some)).to_pylist()
        return b"".join(out)

    def encode_all(self, texts: list[str | None] | pa.Array) -> Iterator[bytes]:
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
        at = 0
        while at < len(texts):
            if sizes[at] > PART:
                yield self.encode(texts[at].as_py())
                at += 1
                continue
            total = np.cumsum(sizes[at : at + TOGETHER])
            end = at + max(1, int(np.searchsorted(total, TOGETHER, "right")))
            end = at + int(np.argmax(np.r_[sizes[at:end] > PART, True]))
            for ids in self.together(pc.fill_null(texts.slice(at, end - at).cast(pa.string()), "")):
                yield ids.as_py()
            at = end
            pa.default_memory_pool().release_unused()

    def together(self, texts: pa.Array) -> pa.Array:
        """Ids of texts. Where each space begins a unit, these stand between the spaces; elsewhere a pattern finds them."""
        spaced = pc.invert(pc.match_substring_regex(texts, RUN))
        mask = spaced.to_numpy(zero_copy_only=False)
        others = [UNIT.findall(t) for t in texts.filter(pc.invert(spaced)).to_pylist()]
        found = pa.array([u for own in others for u in own], pa.string()).dictionary_encode()
        ids = joined(self.units.of(found.dictionary).take(found.indices), np.cumsum([len(own) for own in others], dtype=np.int64))
        return merged(mask, self.between_spaces(texts.filter(spaced)), ids)

    def between_spaces(self, texts: pa.Array) -> pa.Array:
        split = pc.split_pattern(texts, " ")
        at = split.offsets.to_numpy()
        words = split.flatten()
        # A text's first word has no space before it.
        behind, first = words.dictionary_encode(), words.take(pa.array(at[:-1])).dictionary_encode()
        places = behind.indices.to_numpy().copy()
        places[at[:-1]] = first.indices.to_numpy() + len(behind.dictionary)
        segments = pa.concat_arrays([pc.binary_join_element_wise("", behind.dictionary, " "), first.dictionary])
        del split, words, behind, first
        return joined(self.segments(segments).take(pa.array(places)), at[1:])

    def segments(self, segments: pa.Array) -> pa.Array:
        """Ids of what stands between spaces: one plain unit mostly, or some units."""
        plain = pc.match_substring_regex(segments, PLAIN)
        others = [UNIT.findall(s) for s in segments.filter(pc.invert(plain)).to_pylist()]
        one = segments.filter(plain)
        found = pa.concat_arrays([one, pa.array([u for own in others for u in own], pa.string())]).dictionary_encode()
        ids = self.units.of(found.dictionary).take(found.indices)
        return merged(plain.to_numpy(zero_copy_only=False), ids[: len(one)], joined(ids[len(one) :], np.cumsum([len(own) for own in others], dtype=np.int64)))


def worker_words(tokenizer: str) -> Words:
    """The memory of this worker for a tokenizer."""
    return keep(f"words of {tokenizer}", lambda: Words(load(tokenizer)))


def encoder(tokenizer: str) -> Callable[[list[str | None] | pa.Array], Iterator[bytes]]:
    """A function from texts to their ids, as little-endian unsigned 32-bit integers; a null text has none."""
    return worker_words(tokenizer).encode_all
