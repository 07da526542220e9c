"""Token ids of texts by the ``tokenizers`` library, each distinct word encoded once.

Texts are cut into words (for vocabularies in which white space counts, each
with the white-space character before it), a batch's distinct words are encoded
and the ids are dealt back to the texts. The vocabularies' own rules cut a text
at the same places, so a text's ids are the ids of its words in order. Texts in
which that is not sure (longer runs of white space, other white space than
blanks and line feeds, special-token strings) are encoded whole.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.flat import give_back

#: Texts that are encoded whole where white space counts.
_WHOLE = (r"[ \n]{3}|[ \n]{2}\z|[\t\r\x0b\x0c\x00\x1c-\x1f\x85\xa0\x{1680}\x{180e}"
          r"\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]|<\|")
#: Punctuation after a Latin letter that is one in lower case too, up to the word's end,
#: has tokens of its own.
_END = (r"([a-zA-Z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{24f}])"
        r"([.,;:!?#*$%&()\[\]{}\"_/+=~^@`-]+)([ \n\t\r\x0b\x0c]|\z)")
_MARK = "\x00"


def default_path(name: str) -> str:
    """Place of a vocabulary file of the ``public_tokenizers`` package."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Encodes arrays of texts; remembers words and their ids. Beyond ``limit`` words it
    keeps only those of the last batch."""

    def __init__(self, path: str, limit: int = 400_000):
        # Spark's tasks are the parallelism; threads below them only add overhead.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.limit = limit
        self.known = pa.array([], pa.string())
        self.ids = pa.array([], pa.list_(pa.uint32()))  # of the known words
        self.spaces = self._each(["a"])[0].tolist() != self._each([" a"])[0].tolist()
        names = [self.tok.id_to_token(i) or "" for i in range(self.tok.get_vocab_size())]
        self.max_id = max(self.tok.get_vocab().values(), default=0)
        # Tokens that begin a word after a blank or line feed, or that end a word.
        self.edge = np.array([n.startswith(("Ġ", "Ċ")) if self.spaces
                              else n.endswith("</w>") for n in names])

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts``, and how many each has."""
        ids, size = array("I"), []
        for k in range(0, len(texts), 4096):
            # The "fast" call gives the same ids and leaves character offsets out.
            for e in self.tok.encode_batch_fast(texts[k:k + 4096], add_special_tokens=False):
                one = e.ids
                ids.extend(one)
                size.append(len(one))
        return np.array(ids, np.uint32), np.array(size, np.int64)

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words made of letters only, encoded as one running text."""
        text = ("" if self.spaces else " ").join(words)
        ids = np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids,
                       np.uint32)
        edges = np.flatnonzero(self.edge[ids])
        if len(edges) != len(words):
            return self._each(words)
        return ids, np.diff(np.r_[edges, len(ids)] if self.spaces else np.r_[-1, edges])

    def _learn(self, new: pa.Array) -> None:
        at = 1 if self.spaces else 0
        words = new.to_pylist()
        letters = np.array([w[at:].isalpha() and (not at or w[0] in " \n") for w in words], bool)
        order = np.argsort(~letters, kind="stable")
        plain = [words[k] for k in order[:letters.sum()]]
        parts = [self._plain(plain[k:k + 8192]) for k in range(0, len(plain), 8192)]
        parts.append(self._each([words[k] for k in order[len(plain):]]))
        size = np.concatenate([n for _, n in parts])
        ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)], pa.int32()),
                                       pa.array(np.concatenate([x for x, _ in parts])))
        self.known = pa.concat_arrays([self.known, new.take(pa.array(order))])
        self.ids = pa.concat_arrays([self.ids, ids])

    def _words(self, texts: pa.Array) -> pa.ListArray:
        """The words of each text, the punctuation that ends a word apart."""
        if not self.spaces:
            return pc.ascii_split_whitespace(pc.replace_substring_regex(texts, _END, r"\1 \2\3"))
        texts = pc.replace_substring_regex(texts, _END, rf"\1{_MARK}\2\3")
        for c in " \n":
            texts = pc.replace_substring(texts, c, _MARK + c)
        return pc.split_pattern(texts, _MARK)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)``: text ``k`` has ``ids[offsets[k]:offsets[k + 1]]``."""
        odd = ()
        if self.spaces:
            test = pc.match_substring_regex(texts, _WHOLE)
            odd = np.flatnonzero(test.to_numpy(zero_copy_only=False))
            whole, count = self._each(texts.take(pa.array(odd)).to_pylist())
            if len(odd):
                texts = pc.if_else(test, "", texts)
        lists = self._words(texts)
        words = lists.flatten().dictionary_encode()
        place = pc.index_in(words.dictionary, value_set=self.known)
        if len(self.known) > self.limit:  # what this batch does not use makes way
            used = place.drop_null()
            self.known, self.ids = self.known.take(used), self.ids.take(used)
            place = pc.index_in(words.dictionary, value_set=self.known)
        if place.null_count:
            self._learn(words.dictionary.filter(pc.is_null(place)))
            place = pc.index_in(words.dictionary, value_set=self.known)
        found = self.ids.take(place.take(words.indices))
        ids, ends = found.flatten().to_numpy(), found.offsets.to_numpy()
        bounds = lists.offsets.to_numpy()
        offsets = (ends[bounds - bounds[0]] - ends[0]).astype(np.int64)
        if len(odd):
            own = np.split(whole, np.cumsum(count)[:-1])
            whole = dict(zip(odd.tolist(), own))
            parts = [whole.get(k, ids[offsets[k]:offsets[k + 1]]) for k in range(len(texts))]
            offsets = np.r_[0, np.cumsum([len(p) for p in parts])]
            ids = np.concatenate(parts)
        return ids, offsets


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for ``path``; Python workers are reused between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encoded(texts: pa.Array, path: str, size: int = 6_000_000) -> Iterator[np.ndarray]:
    """Ids (uint32) of each text in order, encoding about ``size`` bytes at a time;
    a null text is empty."""
    enc = encoder(path)
    texts = pc.fill_null(texts.cast(pa.string()), "")
    total = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    k = 0
    while k < len(texts):
        done = total[k - 1] if k else 0
        stop = max(k + 1, int(np.searchsorted(total, done + size, "right")))
        give_back()
        ids, offsets = enc(texts.slice(k, stop - k))
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            yield ids[a:b]
        k = stop
