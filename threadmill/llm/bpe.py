"""BPE encoding and decoding by speculation and verification.

Greedy longest match proposes the tokens of a word. Two tokens may stand side
by side in a merge result exactly if merging their joined text gives the two
back, and a sequence is the merge result exactly if that holds for every
adjacent pair. Numpy tests all pairs of a batch at once: it walks the two
tokens' merge trees back in time along the shared edge and looks for a merge
across the edge that would have come first. Only words with a failing pair are
merged exactly.

Texts are prepared as the vocabulary file says: special tokens cut out, NFC,
lower case by character, split into letter runs, single numerals and other
runs, bytes as printable characters. Decoding joins the tokens with a space,
as a file without a decoder asks for. The file is parsed once on the driver
and broadcast: its size is that of the vocabulary, whatever the input. Words
are looked up by 64-bit hash, and a worker remembers ``VOCAB_WORDS`` at most.

Defined results: null and empty texts have no tokens and decode to ''; special
tokens written in a text become their ids; repeated rows repeat their result;
extra columns are passed through by ``encode_documents``.
"""

from __future__ import annotations

import json
import unicodedata

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from threadmill.llm.common import POWERS, Prefix, free_name, mix, slices, starts_of

VOCAB_WORDS = 250_000
NEVER = 1 << 30
#: Added to the last character of a word, which carries the end-of-word suffix.
END = 0xE000

# The split pattern this module carries out, the code points with
# the White_Space property, and the letters and numerals that Unicode 16 added.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
WHITE_SPACE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
NEW_LETTERS = """1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D4A-10D65 10D6F-10D85 10EC2-10EC4
11380-11389 1138B-1138B 1138E-1138E 11390-113B5 113B7-113B7 113D1-113D1 113D3-113D3 11BC0-11BE0
13460-143FA 16100-1611D 16D40-16D6C 18CFF-18CFF 1E5D0-1E5ED 1E5F0-1E5F0"""
NEW_NUMERALS = "10D40-10D49 116D0-116E3 11BF0-11BF9 16130-16139 16D70-16D79 1CCF0-1CCF9 1E5F1-1E5FA"
#: Lower case of the capitals that Unicode 16 and 17 added.
NEW_LOWER = {
    0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB,
    0xA7DC: 0x019B, **{c: c + 0x20 for c in range(0x10D50, 0x10D66)}, **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}
NEW_CAPITAL = regex.compile("[" + "".join(map(chr, NEW_LOWER)) + "]")
BLANK, LETTER, NUMERAL, OTHER = range(4)
LAST = 0x110000


def character_kinds(specials: int) -> np.ndarray:
    """Kind of each code point; the places past the last one stand for special tokens."""
    kinds = np.full(LAST + specials, OTHER, np.uint8)
    for c in range(LAST):
        k = unicodedata.category(chr(c))[0]
        if k == "L":
            kinds[c] = LETTER
        elif k == "N":
            kinds[c] = NUMERAL
    for spans, kind in ((NEW_LETTERS, LETTER), (NEW_NUMERALS, NUMERAL)):
        for span in spans.split():
            x, y = span.split("-")
            kinds[int(x, 16) : int(y, 16) + 1] = kind
    kinds[WHITE_SPACE] = BLANK
    kinds[LAST:] = NUMERAL
    return kinds


def _byte_chars() -> list[str]:
    """The printable character of each byte in byte-level vocabularies: itself
    where it is printable, else the next free code point from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {b: chr(b) for b in own}, 256
    for b in range(256):
        if b not in out:
            out[b] = chr(extra)
            extra += 1
    return [out[b] for b in range(256)]


class Vocabulary:
    """Tokens and merges of a vocabulary file, with what the pair test needs."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        if spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] != PATTERN:
            raise ValueError(f"{file} splits texts by another pattern")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.kinds = character_kinds(len(self.special))
        vocab = model["vocab"]
        self.size = size = max([*vocab.values(), *self.special.values()]) + 1
        self.text = [""] * size
        for t, i in {**vocab, **self.special}.items():
            self.text[i] = t
        self.left, self.right = np.arange(size), np.arange(size)
        self.born = np.full(size, -1, np.int64)
        keys, ranks, made = [], [], []
        for r, (a, b) in enumerate(model["merges"]):
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            keys.append(x * size + y)
            ranks.append(r)
            made.append(z)
            if self.born[z] < 0:
                self.born[z], self.left[z], self.right[z] = r, x, y
        self.pair_keys, first = np.unique(np.array(keys, np.int64), return_index=True)
        self.pair_ranks, self.pair_made = np.array(ranks)[first], np.array(made)[first]

        def units(token: str) -> str:
            if token.endswith(suffix) and token != suffix:
                token = token[: -len(suffix)]
                return token[:-1] + chr(ord(token[-1]) + END)
            return token

        shown = {units(t): i for t, i in vocab.items()}
        self.unit = np.full(2 * END, -1, np.int64)
        for t, i in shown.items():
            if len(t) == 1:
                self.unit[ord(t)] = i
        # a proposal may only hold tokens that merging their own text gives back
        texts, ids = list(shown), np.array(list(shown.values()))
        flat, counts = self.merge(texts)
        alone = (counts == 1) & (flat[np.minimum(starts_of(counts)[:-1], len(flat) - 1)] == ids)
        self.proposals = [(t, int(i)) for t, i, ok in zip(texts, ids, alone) if ok]

    def ranked(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, token made) of merging each pair; NEVER where there is no merge."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        hit = (self.pair_keys[at] == key) & (a >= 0) & (b >= 0)
        return np.where(hit, self.pair_ranks[at], NEVER), self.pair_made[at]

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of all words at once: in each round every word merges
        its lowest-ranked pair, leftmost first. Returns (flat ids, ids by word)."""
        lens = np.array([len(w) for w in words], np.int64)
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        ids = self.unit[codes]
        owner = np.repeat(np.arange(len(words)), lens)[ids >= 0]
        ids = ids[ids >= 0]
        n = len(ids)
        rank, made = np.full(n, NEVER), np.zeros(n, np.int64)
        if n > 1:
            rank[:-1], made[:-1] = self.ranked(ids[:-1], ids[1:])
            rank[:-1][owner[1:] != owner[:-1]] = NEVER
        done_ids, done_owner = [], []
        while len(ids):
            least = np.full(len(words), NEVER)
            np.minimum.at(least, owner, rank)
            active = least[owner] < NEVER
            done_ids.append(ids[~active])
            done_owner.append(owner[~active])
            ids, owner, rank, made = ids[active], owner[active], rank[active], made[active]
            if not len(ids):
                break
            take = rank == least[owner]
            # of pairs that overlap (runs of one token) every second one, from the left
            at = np.flatnonzero(take)
            run = np.concatenate(([True], np.diff(at) > 1))
            nth = np.arange(len(at)) - np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[nth % 2 == 0]
            ids[at] = made[at]
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            new = np.zeros(len(ids), bool)
            new[at] = True
            ids, owner, rank, made, new = ids[stay], owner[stay], rank[stay], made[stay], new[stay]
            touched = new.copy()
            touched[:-1] |= new[1:]
            touched[-1] = False
            t = np.flatnonzero(touched)
            rank[t], made[t] = self.ranked(ids[t], ids[t + 1])
            rank[t[owner[t] != owner[t + 1]]] = NEVER
            rank[-1] = NEVER
        ids, owner = np.concatenate(done_ids or [ids]), np.concatenate(done_owner or [owner])
        order = np.argsort(owner, kind="stable")
        return ids[order], np.bincount(owner, minlength=len(words))

    def proposer(self) -> ahocorasick.Automaton:
        """Leftmost-longest matcher of the tokens: greedy longest match."""
        out = ahocorasick.Automaton()
        for t, i in self.proposals:
            out.add_word(t, (i, len(t)))
        out.make_automaton()
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For pairs of tokens: whether merging their joined text gives the two back."""
        ok = np.ones(len(a), bool)
        rows = np.arange(len(a))
        a, b = a.copy(), b.copy()
        end_a, end_b = np.full(len(a), NEVER), np.full(len(a), NEVER)
        while len(rows):
            r, _ = self.ranked(a, b)
            # across the edge first: before a's next merge, and not after b's (leftmost wins a tie)
            broken = (r < end_a) & (r <= end_b) & (r < NEVER)
            ok[rows[broken]] = False
            born_a, born_b = self.born[a], self.born[b]
            go = ~broken & ((born_a >= 0) | (born_b >= 0))
            undo_a = born_a > born_b  # the later of the two merges is undone first
            end_a, end_b = np.where(undo_a, born_a, end_a), np.where(undo_a, end_b, born_b)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
            rows, a, b, end_a, end_b = (v[go] for v in (rows, a, b, end_a, end_b))
        return ok

    def encode_words(self, words: list[str], proposer: ahocorasick.Automaton) -> tuple[np.ndarray, np.ndarray]:
        """(flat token ids, their number by word) of words in unit characters."""
        lens = np.array([len(w) for w in words], np.int64)
        begin = starts_of(lens + 1)[:-1]
        hits = [(end, i, n) for end, (i, n) in proposer.iter_long("\n".join(words))]
        end, flat, n = np.array(hits, np.int64).reshape(-1, 3).T
        owner = np.searchsorted(begin, end, side="right") - 1
        again = np.bincount(owner, n, minlength=len(words)) != lens
        inside = owner[1:] == owner[:-1]
        a, b, who = flat[:-1][inside], flat[1:][inside], owner[1:][inside]
        pairs, inv = np.unique(a * self.size + b, return_inverse=True)
        bad = ~self.compatible(pairs // self.size, pairs % self.size)[inv]
        again[who[bad]] = True
        redo = np.flatnonzero(again)
        keep = ~again[owner]
        flat, owner = flat[keep], owner[keep]
        if len(redo):
            exact, counts = self.merge([words[i] for i in redo])
            flat = np.concatenate((flat, exact))
            owner = np.concatenate((owner, np.repeat(redo, counts)))
        order = np.argsort(owner, kind="stable")
        return flat[order], np.bincount(owner, minlength=len(words))


class Encoder:
    """A worker's state: the words met so far and their tokens."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.proposer = vocabulary.proposer()
        self.specials = list(vocabulary.special)
        longest_first = sorted(self.specials, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.specials else None
        self.opening = {s[0] for s in self.specials}
        self.table = dict(enumerate(_byte_chars()))
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int64)
        self.pieces: list[str] = []
        self.start = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _parts(self, text: str) -> list[np.ndarray]:
        """Normalised code points of a text, special tokens as places past the last."""
        if self.cut is not None and any(c in text for c in self.opening):
            cut = self.cut.split(text)
        else:
            cut = [text]
        out = []
        for k, part in enumerate(cut):
            if k % 2:
                out.append(np.array([LAST + self.specials.index(part)], np.uint32))
            elif part:
                if not part.isascii():
                    part = unicodedata.normalize("NFC", part)
                    if "\u03a3" in part:  # by character: no final sigma
                        part = part.replace("\u03a3", "\u03c3")
                    if NEW_CAPITAL.search(part):
                        part = part.translate(NEW_LOWER)
                out.append(np.frombuffer(part.lower().encode("utf-32-le"), "<u4"))
        return out

    def _split(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of each word: runs of a kind, numerals one by one, and
        an apostrophe with the ending after it where it stands alone before letters."""
        kind = self.v.kinds[codes]
        edge = np.ones(len(kind) + 1, bool)
        edge[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMERAL)
        at = np.flatnonzero(edge)
        begin, end = at[:-1].copy(), at[1:].copy()
        kinds = kind[begin]
        alone = (kinds == OTHER) & (end - begin == 1) & (codes[begin] == 0x27)
        alone[-1:] = False
        alone[:-1] &= kinds[1:] == LETTER
        if alone.any():
            i = np.flatnonzero(alone)
            one = codes[end[i]]
            two = np.where(end[i + 1] - end[i] > 1, codes[np.minimum(end[i] + 1, len(codes) - 1)], 0)
            take = np.zeros(len(i), np.int64)
            for e in ENDINGS:
                hit = one == ord(e[0]) if len(e) == 1 else (one == ord(e[0])) & (two == ord(e[1]))
                take = np.where((take == 0) & hit, len(e), take)
            end[i] += take
            begin[i + 1] += take
        stay = (begin < end) & (kinds != BLANK)
        return begin[stay], end[stay]

    def learn(self, hashes: np.ndarray, begin: np.ndarray, end: np.ndarray, codes: np.ndarray) -> None:
        words, table = [], self.table
        special: dict[int, int] = {}
        for k, (x, y) in enumerate(zip(begin.tolist(), end.tolist())):
            if codes[x] >= LAST:
                special[k] = self.v.special[self.specials[codes[x] - LAST]]
                words.append("")
                continue
            w = codes[x:y].tobytes().decode("utf-32-le").encode().decode("latin-1").translate(table)
            words.append(w[:-1] + chr(ord(w[-1]) + END))
        flat, counts = self.v.encode_words(words, self.proposer)
        for k, i in special.items():
            flat = np.insert(flat, counts[:k].sum(), i)
            counts[k] = 1
        at = starts_of(counts)
        text, ids = self.v.text, flat.tolist()
        place = len(self.pieces) + np.arange(len(words))
        self.pieces += [" ".join([text[t] for t in ids[x:y]]) for x, y in zip(at[:-1].tolist(), at[1:].tolist())]
        self.start = np.append(self.start, self.start[-1] + at[1:])
        self.flat = np.concatenate((self.flat, flat.astype(np.uint32)))
        known, place = np.concatenate((self.known, hashes)), np.concatenate((self.place, place))
        order = np.argsort(known)
        self.known, self.place = known[order], place[order]

    def encode(self, texts: list[str | None]) -> tuple[list[bytes], list[str]]:
        """(ids as little-endian unsigned 32-bit integers, decoded text) of each text."""
        if len(self.known) > VOCAB_WORDS:
            self.forget()
        blank = np.array([32], np.uint32)
        parts, lens = [], np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            own = [*(self._parts(t) if t else ()), blank]
            lens[i] = sum(map(len, own))
            parts += own
        codes = np.concatenate(parts)
        begin, end = self._split(codes)
        first = np.searchsorted(begin, starts_of(lens))
        hashes = Prefix(mix(codes.astype(np.uint64) + np.uint64(1)), POWERS).of(begin, end)
        u, at, inv = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known):
            p = np.minimum(np.searchsorted(self.known, u), len(self.known) - 1)
            new = self.known[p] != u
        else:
            new = np.ones(len(u), bool)
        if new.any():
            self.learn(u[new], begin[at[new]], end[at[new]], codes)
        word = self.place[np.searchsorted(self.known, u)][inv] if len(u) else np.zeros(0, np.int64)
        n = np.diff(self.start)[word]
        token = starts_of(n)
        flat = self.flat[np.repeat(self.start[word] - token[:-1], n) + np.arange(token[-1])].astype("<u4")
        ids = [flat[token[x] : token[y]].tobytes() for x, y in zip(first[:-1], first[1:])]
        pieces, order = self.pieces, word.tolist()
        decoded = [" ".join([pieces[k] for k in order[x:y]]) for x, y in zip(first[:-1].tolist(), first[1:].tolist())]
        return ids, decoded


#: The encoder of this worker process, kept from task to task, by vocabulary.
_ENCODERS: dict[int, Encoder] = {}


def _encode(vocabulary_ref, text_at: int, schema: list[str]):
    def run(batches):
        v = vocabulary_ref.value
        if id(v) not in _ENCODERS:
            _ENCODERS.clear()
            _ENCODERS[id(v)] = Encoder(v)
        encoder = _ENCODERS[id(v)]
        for b in batches:
            texts = b.column(text_at).to_pylist()
            for x, y in slices(texts):
                ids, decoded = encoder.encode(texts[x:y])
                part = b.slice(x, y - x)
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array([len(i) // 4 for i in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array(decoded, pa.string()),
                    ],
                    schema,
                )

    return run


def load_vocabulary(spark: SparkSession, file: str):
    """Broadcast of the parsed vocabulary file (driver-side path)."""
    return spark.sparkContext.broadcast(Vocabulary(file))


def encode_documents(docs: DataFrame, file: str) -> tuple[DataFrame, str, str, str]:
    """``docs`` with three more columns, whose names are returned with the frame:
    the number of tokens, their ids (binary, four bytes each, little-endian) and
    the text they decode to."""
    added = [free_name(docs.columns, c) for c in ("n_tokens", "ids", "decoded")]
    kinds = [T.LongType(), T.BinaryType(), T.StringType()]
    fields = [f.dataType for f in docs.schema.fields] + kinds
    inner = T.StructType([T.StructField(f"c{i}", k) for i, k in enumerate(fields)])
    text_at = next(i for i, c in enumerate(docs.columns) if c.lower() == "text")
    ref = load_vocabulary(docs.sparkSession, file)
    out = docs.toDF(*inner.names[: len(docs.columns)]).mapInArrow(_encode(ref, text_at, inner.names), inner)
    return out.toDF(*docs.columns, *added), *added
