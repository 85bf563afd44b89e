"""Token ids of whole texts from a public vocabulary file, by the ``tokenizers`` library.

The library's full run spends most of its time on words it has met before. Both
vocabularies used here cut a text into words before they merge, and never merge across
the border between a word and the space, or the single line break, that follows it. So a
text is cut at such borders, the library's model is asked once for each new word, and the
ids of a text are the ids of its words in order. Only plain words (letters, and letters
before marks of punctuation) go to the model directly; every other piece goes through
the library's full run. Words that touch other white space are encoded in one piece with
their neighbours, as the borders inside a run of white space depend on the whole run.
"""

from __future__ import annotations

import functools
import os

# Words a task remembers in each of two generations, some 50 MB each. Bounds its memory only.
PIECES = 250_000
# Marks that make a piece of their own when they follow a word's letters: ASCII's that are
# neither letters, digits nor blanks.
MARKS = "".join(chr(b) for b in range(33, 127) if not chr(b).isalnum())


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for
    themselves, the others follow in order from code 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: b for b in shown} | {b: 256 + k for k, b in enumerate(hidden)}


class Encoder:
    """``encode(text)`` gives the ids as little-endian unsigned 32-bit integers.

    ``path`` is a byte-level vocabulary file whose words begin with the space before
    them, or drop white space and case (``folds``). Null counts as empty. The ids are those
    of the library's plain call, in which the text of an added token such as
    <|endoftext|> gets that token's id, if ``added``; otherwise it counts as plain words.
    Added tokens hold no white space, so no cut goes through one.
    """

    def __init__(self, path: str, folds: bool = False, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._library.encode_special_tokens = not added
        self._model = self._library.model
        self._fold = self._library.normalizer.normalize_str if folds else None
        self._letters = _byte_letters()
        ids = range(max(self._library.get_vocab(True).values()) + 1)
        self._bytes = [i.to_bytes(4, "little") for i in ids]
        self._ends: dict[str, bytes] = {}
        self._break = self._run("\n")
        # Pieces as ``encode`` cuts them: ids with the space or line break before the
        # word; False: other white space touches it. The first words of texts are apart.
        self._new: dict[str, bytes | bool] = {}
        self._old: dict[str, bytes | bool] = {}
        self._first: dict[str, bytes] = {}

    def _run(self, piece: str) -> bytes:
        import numpy as np

        if not piece:
            return b""
        return np.array(self._library.encode(piece, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str, spaced: bool) -> bytes:
        """Letters only, with a space before them if ``spaced``."""
        if word.isascii():
            word = "\u0120" + word if spaced else word
        else:
            word = (" " + word if spaced else word).encode().decode("latin-1").translate(self._letters)
        found = self._model.tokenize(word)
        if len(found) == 1:
            return self._bytes[found[0].id]
        return b"".join([self._bytes[t.id] for t in found])

    def _known(self, piece: str) -> bytes | bool:
        """The ids of a piece that is not among the newest ones yet."""
        ids = self._old.get(piece)
        if ids is None:
            ids = self._folded(piece) if self._fold else self._spaced(piece)
        self._new[piece] = ids
        return ids

    def _end(self, marks: str) -> bytes:
        ids = self._ends.get(marks)
        if ids is None:
            if len(self._ends) >= PIECES // 8:
                self._ends.clear()
            self._ends[marks] = ids = self._run(marks)
        return ids

    def _plain(self, word: str, spaced: bool) -> bytes:
        """Letters without their marks, which other pieces share."""
        ids = self._new.get(word)
        if ids is None:
            ids = self._old.get(word)
            self._new[word] = ids = self._word(word, spaced) if ids is None else ids
        return ids

    def _folded(self, piece: str) -> bytes:
        # Below U+0250 every letter is composed and has its lower case for itself.
        plain = piece.lower() if piece.isascii() or max(piece) < "\u0250" else self._fold(piece)
        if plain.isalpha():
            return self._word(plain, False)
        letters = plain.rstrip(MARKS)
        if letters.isalpha():
            return self._plain(letters, False) + self._end(plain[len(letters) :])
        return self._run(piece)

    def _spaced(self, piece: str) -> bytes | bool:
        broken = piece[:1] == "\n"
        word = piece[1:] if broken else piece
        if word.isalpha():
            return self._break + self._word(word, False) if broken else self._word(word, True)
        if not word or word[0].isspace() or word[-1].isspace():
            return False
        letters = word.rstrip(MARKS)
        if letters.isalpha():
            end = self._end(word[len(letters) :])
            return self._break + self._word(letters, False) + end if broken else self._plain(letters, True) + end
        return self._run(piece if broken else " " + piece)

    def _start(self, word: str) -> bytes:
        """The first word of a text: nothing is before it."""
        ids = self._first.get(word)
        if ids is None:
            if len(self._first) >= PIECES // 8:
                self._first.clear()
            letters = word.rstrip(MARKS)
            ids = self._word(letters, False) + self._end(word[len(letters) :]) if letters.isalpha() else self._run(word)
            self._first[word] = ids
        return ids

    def forget(self) -> None:
        """Drop the words met so far."""
        for known in (self._new, self._old, self._first, self._ends):
            known.clear()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if len(self._new) >= PIECES:
            self._old, self._new = self._new, {}
        # Each line break keeps its place at the head of the word behind it.
        words = text.replace("\n", " " if self._fold else " \n").split(" ")
        found = list(map(self._new.get, words))
        if None in found:
            known = self._known
            found = [known(w) if ids is None else ids for w, ids in zip(words, found)]
        if self._fold:
            return b"".join(found)
        if False in found:
            return self._joined(words, found)
        found[0] = self._start(words[0])
        return b"".join(found)

    def _joined(self, words: list[str], found: list[bytes | bool]) -> bytes:
        """Words that touch other white space go with both neighbours into one piece."""
        out, start = [], 0
        for k in range(1, len(words) + 1):
            if k == len(words) or not (found[k - 1] is False or found[k] is False):
                out.append(self._piece(words, found, start, k))
                start = k
        return b"".join(out)

    def _piece(self, words: list[str], found: list[bytes | bool], start: int, end: int) -> bytes:
        if end - start == 1 and found[start] is not False:
            return self._start(words[0]) if start == 0 else found[start]
        # The space before each line break was put there by ``encode``.
        spaced = start > 0 and words[start][:1] != "\n"
        return self._run(" " * spaced + " ".join(words[start:end]).replace(" \n", "\n"))


@functools.cache
def shared_encoder(name: str, folds: bool = False) -> Encoder:
    """One encoder per vocabulary and worker process, with the ids of the library's plain
    call: tasks that follow each other there do not load the file again. They call
    ``forget`` at their end, as an idle worker keeps its memory."""
    return Encoder(vocabulary(name), folds, added=True)
