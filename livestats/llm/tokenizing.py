"""Byte-level BPE ids of whole texts, by the ``tokenizers`` library.

A byte-level BPE never merges across its pre-token borders, and a border lies
wherever a space or line break follows a non-space.  A batch of texts is cut
there into units (a word with the white space before it), Arrow finds the
batch's distinct units, the library encodes those that are new, and the ids of
each text are gathered from the units.  The result equals
``Tokenizer.encode`` of each whole text.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Units kept between batches of a worker.
TABLE_UNITS = 600_000
#: Units joined into one text for the library, and such texts in a call.
CALL_UNITS, CALL_TEXTS = 64, 64
#: Ids gathered at once.
GATHER_IDS = 4_000_000

# RE2's \s knows ASCII only; a text with any other white space, or with the
# cutting mark itself, is encoded by the library alone.
_ALONE = ("[\\x01\\t\\r\\v\\f\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}"
          "\\x{202f}\\x{205f}\\x{3000}]")
_RUNS = "[ \\n][ \\n]"
_MARK = "\x01"
#: The letter that byte-level vocabularies write for a line break.
_BREAK = "\u010a"
# A unit of letters with closing marks: two pre-tokens, of which the first is
# one word for the vocabulary's merges.
_WORD = "^(?P<word>[ \\n]?[A-Za-zÀ-ÖØ-öø-ſ]+)(?P<tail>[.,;:!?|)]*)$"


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte but the line break."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    letters = {b: chr(b) for b in kept} | {b: chr(256 + k) for k, b in enumerate(rest)}
    return {b: x for b, x in letters.items() if b != 10}


def _runs(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of each run, one run after the other."""
    ends = np.cumsum(lens)
    shift = (starts - (ends - lens)).astype(np.int32)
    return np.repeat(shift, lens) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)


class IdEncoder:
    """Encodes Arrow arrays of texts with one vocabulary file."""

    def __init__(self, path: str, table_units: int = TABLE_UNITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # its merges alone, over words that stand between line breaks
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.Split(_BREAK, "isolated")
        # texts that hold the string of an added token are left to the library
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = str.maketrans({chr(b): x for b, x in _byte_letters().items()})
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        (self.line_break,) = self.alone("\n")
        self.table_units = table_units
        self._empty()

    def _empty(self) -> None:
        self.units = pa.array([], pa.string())
        self.pool = np.empty(0, self.dtype)
        self.starts = np.empty(0, np.int64)
        self.lens = np.empty(0, np.int64)
        self.seen = np.empty(0, np.int32)

    def _forget(self) -> None:
        """Drop the units that one batch alone had; all of them if that leaves more than half."""
        kept = np.flatnonzero(self.seen > 1)
        units, pool, starts, lens = self.units, self.pool, self.starts[kept], self.lens[kept]
        self._empty()
        if 0 < 2 * len(kept) <= self.table_units:
            self._add(units.take(pa.array(kept)), pool[_runs(starts, lens)], lens)

    def alone(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)

    def _listed(self, words: list[str], lead: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids and id counts of each ``lead + word``: texts of lines, cut again at the line breaks."""
        texts = ["".join([f"{lead}{w}\n" for w in words[i:i + CALL_UNITS]])
                 for i in range(0, len(words), CALL_UNITS)]
        return self._between(self.tokenizer, texts)

    def _between(self, tokenizer, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts without line breaks, and their number before each line break."""
        ids = [np.array(e.ids, self.dtype) for i in range(0, len(texts), CALL_TEXTS)
               for e in tokenizer.encode_batch_fast(texts[i:i + CALL_TEXTS], add_special_tokens=False)]
        flat = np.concatenate(ids) if ids else np.empty(0, self.dtype)
        breaks = flat == self.line_break
        return flat[~breaks], np.diff(np.flatnonzero(breaks), prepend=-1) - 1

    def _add(self, units: pa.Array, ids: np.ndarray, lens: np.ndarray) -> None:
        self.starts = np.concatenate((self.starts, len(self.pool) + np.cumsum(lens) - lens))
        self.lens = np.concatenate((self.lens, lens))
        self.seen = np.concatenate((self.seen, np.zeros(len(lens), np.int32)))
        self.pool = np.concatenate((self.pool, ids)).astype(self.dtype, copy=False)
        self.units = pa.concat_arrays([self.units, units])

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and id counts of single words, by the vocabulary's merges alone."""
        lines = "\n".join([*words.to_pylist(), ""]).encode().decode("latin-1").translate(self.letters).split("\n")
        texts = [_BREAK.join([*lines[i:min(i + CALL_UNITS, len(words))], ""]) for i in range(0, len(words), CALL_UNITS)]
        return self._between(self.merges, texts)

    def _learn(self, units: pa.Array) -> None:
        """Add units to the table."""
        is_word = pc.match_substring_regex(units, _WORD)
        some = pc.filter(units, is_word)
        if len(some):
            parts = pc.extract_regex(some, _WORD)
            breaks = pc.starts_with(some, "\n").to_numpy(zero_copy_only=False)
            word = pc.replace_substring_regex(parts.field("word"), "^\n", "").dictionary_encode()
            tail = parts.field("tail").dictionary_encode()
            ids, lens = self._words(word.dictionary)
            tails = [self.alone(t) for t in tail.dictionary.to_pylist()]
            w, t = (x.indices.to_numpy(zero_copy_only=False) for x in (word, tail))
            # every unit as three runs of a pool: a line break or nothing, the word, the tail
            pool = np.concatenate((ids, [self.line_break], *tails)).astype(self.dtype)
            n_tail = np.fromiter(map(len, tails), np.int64, len(tails))
            at_tail = len(ids) + 1 + np.cumsum(n_tail) - n_tail
            n = np.column_stack((breaks, lens[w], n_tail[t])).astype(np.int64)
            at = np.column_stack((np.full(len(w), len(ids)), (np.cumsum(lens) - lens)[w], at_tail[t]))
            self._add(some, pool[_runs(at.ravel(), n.ravel())], n.sum(axis=1))
        rest = pc.filter(units, pc.invert(is_word))
        for lead, pattern in ((" ", "^ [^ \\n]+$"), ("\n", "^\\n[^ \\n]+$"), ("", "^[^ \\n]+$")):
            some = pc.filter(rest, pc.match_substring_regex(rest, pattern))
            if not len(some):
                continue
            words = pc.utf8_slice_codeunits(some, len(lead)).to_pylist()
            ids, lens = self._listed(words, " " if lead == " " else "")
            if lead == "\n":
                ids = np.insert(ids, np.cumsum(lens) - lens, self.line_break)
                lens = lens + 1
            self._add(some, ids, lens)
        rest = pc.filter(rest, pc.invert(pc.match_substring_regex(rest, "^[ \\n]?[^ \\n]+$")))
        if len(rest):
            got = [self.alone(u) for u in rest.to_pylist()]
            self._add(rest, np.concatenate(got), np.fromiter((len(x) for x in got), np.int64, len(got)))

    def _cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The units of all texts and their number in each text."""
        runs = pc.match_substring_regex(texts, _RUNS)
        one = pc.replace_substring(pc.replace_substring(texts, " ", _MARK + " "), "\n", _MARK + "\n")
        if pc.any(runs).as_py():
            many = pc.replace_substring_regex(texts, "([^ \\n])([ \\n])", "\\1" + _MARK + "\\2")
            one = pc.if_else(runs, many, one)
        lists = pc.split_pattern(one, _MARK)
        return lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and how many each has; NULL is the empty text."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.fill_null(texts, "")
        if len(texts) == 0:
            return np.empty(0, self.dtype), np.empty(0, np.int64)
        alone = pc.match_substring_regex(texts, _ALONE)
        for token in self.added:
            alone = pc.or_(alone, pc.match_substring(texts, token))
        units, counts = self._cut(pc.if_else(alone, "", texts))
        found = units.dictionary_encode()
        words, at = found.dictionary, found.indices.to_numpy(zero_copy_only=False)
        if len(self.units) > self.table_units:
            self._forget()
        known = pc.index_in(words, value_set=self.units)
        is_new = pc.is_null(known)
        new = pc.filter(words, is_new)
        n_before = len(self.units)
        if len(new):
            self._learn(new)
        known = pc.fill_null(known, -1)
        known = known.to_numpy(zero_copy_only=False).astype(np.int64)
        if len(new):
            own = pc.index_in(new, value_set=self.units.slice(n_before)).to_numpy(zero_copy_only=False)
            known[is_new.to_numpy(zero_copy_only=False)] = n_before + own.astype(np.int64)
        self.seen[known] += 1
        starts, lens = self.starts[known], self.lens[known]
        unit_lens = lens[at]
        ends = np.cumsum(counts)
        per_text = np.add.reduceat(unit_lens, ends - counts)
        parts, ids_to = [], np.cumsum(unit_lens)
        lo = 0
        while lo < len(at):  # a bounded number of ids at a time
            base = ids_to[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ids_to, base + GATHER_IDS)))
            parts.append(self.pool[_runs(starts[at[lo:hi]], unit_lens[lo:hi])])
            lo = hi
        ids = np.concatenate(parts)
        if pc.any(alone).as_py():
            pieces = np.split(ids, np.cumsum(per_text)[:-1])
            for i in np.flatnonzero(alone.to_numpy(zero_copy_only=False)):
                pieces[i] = self.alone(texts[i].as_py())
            ids = np.concatenate(pieces)
            per_text = np.fromiter((len(p) for p in pieces), np.int64, len(pieces))
        return ids, per_text


_ENCODERS: dict[str, IdEncoder] = {}


def encoder(path: str) -> IdEncoder:
    """The worker's encoder of a vocabulary file; kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = IdEncoder(path)
    return _ENCODERS[path]


def default_vocabulary() -> str:
    """Place of the vocabulary file that the registered queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
