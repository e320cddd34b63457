"""Token ids of whole texts by a public tokenizer file, quickly: repeated words are looked up."""

from __future__ import annotations

import string
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

REMEMBERED = 600_000  # pieces after which a worker starts a new memory, taking from the last one what it meets again
END_ID = 1


JOINED = 256  # plain words encoded as one text
MARK = "."
TAILS = string.punctuation.replace("'", "")  # a run of these after a word and before a blank is a piece of its own


def _wordlike(piece: str) -> bool:
    """Letters, with at most one blank before them, that stay letters when a vocabulary normalises them."""
    bare = piece[piece[:1] == " ":]
    return bare.isalpha() and (bare.isascii() or unicodedata.normalize("NFC", bare).lower().isalpha())


class Earlier:
    """Pieces of an earlier memory and their ids in a quarter of its room, told apart by hash and then by themselves."""

    def __init__(self, known: dict[str, bytes]):
        hashes = np.fromiter(map(hash, known), np.int64, len(known))
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.pieces, self.ids = (pa.array(x, kind).take(order) for x, kind in ((known.keys(), pa.large_string()), (known.values(), pa.large_binary())))

    def among(self, pieces: list[str]) -> dict[str, bytes]:
        """Those of `pieces` that are remembered, with their ids."""
        if not len(self.hashes) or not pieces:
            return {}
        hashes = np.fromiter(map(hash, pieces), np.int64, len(pieces))
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        alike = np.flatnonzero(self.hashes[at] == hashes)  # of two pieces with one hash the second is learnt again
        some, at = [pieces[i] for i in alike.tolist()], at[alike]
        same = pc.equal(self.pieces.take(at), pa.array(some, pa.large_string())).to_numpy(zero_copy_only=False).tolist()
        ids = self.ids.take(at).to_numpy(zero_copy_only=False).tolist()
        return {p: i for p, i, ok in zip(some, ids, same, strict=True) if ok}


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes (the byte order of the machines Spark runs on).

    A byte-level vocabulary takes a space with the word after it, so a text whose white space is single
    blanks and line breaks is cut before each of them; one that drops white space can be cut at any blank.
    These cuts are always token borders. Other texts go to the tokenizer whole. Each different piece of a
    batch is looked up once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model.model._resize_cache(0)  # it is given hardly any word twice
        # letters alone are one piece for either vocabulary, so nothing need look for borders in them
        self.borders, self.letters = self.model.pre_tokenizer, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.apart = pre_tokenizers.Sequence([pre_tokenizers.Split(MARK, "isolated"), self.letters])
        self.mark = self._ids([MARK])[0]
        self.spaced = self._ids(["a b"]) != self._ids(["a  b"])
        self.known: dict[str, bytes] = {}
        self.last = Earlier({})

    def _ids(self, texts: list[str], plain: bool = False) -> list[bytes]:
        """Ids of each text; `plain` texts are single pieces. A few thousand at a time: results take far more room than ids."""
        self.model.pre_tokenizer = self.letters if plain else self.borders
        out: list[bytes] = []
        for at in range(0, len(texts), 2048):
            out += [array("I", e.ids).tobytes() for e in self.model.encode_batch_fast(texts[at:at + 2048], add_special_tokens=False)]
        return out

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of plain words, many in one text with a mark between them, which no word holds and which is always one id.

        A word then costs what its merges cost, and not a call's result as well.
        """
        if len(self.mark) != 4:
            return self._ids(words, True)
        self.model.pre_tokenizer = self.apart
        mark, out = int.from_bytes(self.mark, "little"), []
        for at in range(0, len(words), JOINED):
            ids = np.array(self.model.encode_batch_fast([MARK.join(words[at:at + JOINED])], add_special_tokens=False)[0].ids, np.uint32)
            data, ends = ids.tobytes(), np.flatnonzero(ids == mark) * 4
            out += map(data.__getitem__, map(slice, [0, *(ends + 4).tolist()], [*ends.tolist(), len(data)]))
        return out

    def _learn(self, pieces: list[str]) -> None:
        """Ids of new pieces: a word with a line break before it or marks after it from its parts, plain words many at once, the rest in full."""
        known = self.known
        again = self.last.among(pieces)
        known.update(again)
        words, rest, joined = set(), set(), []
        for piece in pieces:
            if piece in again:
                continue
            word = piece.rstrip(TAILS)
            n, head = len(word), piece[:1] if piece[:1] == "\n" else ""
            if head:
                word = word[1:]
            if not _wordlike(word):
                rest.add(piece)
                continue
            words.add(word)
            if len(word) < len(piece):
                rest.update((head, piece[n:]))
                joined.append((piece, head, word, piece[n:]))
        for some, ids in ((words, self._word_ids), (rest, self._ids)):
            known.update(self.last.among([p for p in some if p not in known]))
            new = [p for p in some if p not in known]
            known.update(zip(new, ids(new), strict=True))
        known.update((piece, known[head] + known[word] + known[tail]) for piece, head, word, tail in joined)

    def _looked_up(self, pieces: list[str]) -> list[bytes]:
        """Ids of different pieces."""
        ids = list(map(self.known.get, pieces))
        holes = [i for i, found in enumerate(ids) if found is None]
        self._learn([pieces[i] for i in holes])
        for i in holes:
            ids[i] = self.known[pieces[i]]
        return ids

    def _cut(self, text: str) -> str | None:
        """The text with its borders marked."""
        if not self.spaced:
            return text.replace("\n", " ")
        joined = text.replace("\n", " ")
        if "  " in joined or not joined.isprintable():  # runs, tabs, other blanks, control characters
            return None
        return text.replace(" ", "\0 ").replace("\n", "\0\n")

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.last, self.known = Earlier(self.known), {}
        cut = [self._cut(t) for t in texts]
        whole = iter(self._ids([t for t, c in zip(texts, cut, strict=True) if c is None]))
        pieces = pc.split_pattern(pa.array([c for c in cut if c is not None], pa.large_string()), "\0" if self.spaced else " ")
        each = pieces.flatten().dictionary_encode()
        ids = pa.array(self._looked_up(each.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(each.indices)
        _, ends, data = ids.buffers()
        at = np.frombuffer(ends, np.int64, len(ids) + 1)[pieces.offsets.to_numpy()].tolist() if len(ids) else [0] * (len(pieces) + 1)
        data, parts = memoryview(data or b""), iter(zip(at, at[1:], strict=False))
        return [next(whole) if c is None else bytes(data[slice(*next(parts))]) for c in cut]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def texts_of(column: pa.Array) -> list[str]:
    """NULL counts as empty."""
    return [t or "" for t in column.to_pylist()]
