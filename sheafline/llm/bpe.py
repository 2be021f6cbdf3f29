"""Byte-level BPE as a lazily determinised finite-state transducer, with streaming UTF-8 decoding.

Compilation. A token sequence is what the merges give for its bytes exactly if every token encodes to itself and every
adjacent pair encodes to that pair (Berglund and van der Merwe, "Formalizing BPE Tokenization"). So the merges become a
nondeterministic transducer that reads a token byte by byte, may start one at every byte, and is composed with the relation
of the pairs that may stand together. Each prefix of a text has exactly one encoding, so of the tokens that can end at a
byte just one may follow the encoding of what stands before it.

Determinisation. A state of the subset construction is the set of tokens being read; only the sets that texts reach are
built, and each transition lists the tokens that can end there. Which of them follows what stands before is asked of the
relation of pairs, whose answers are remembered with the token. So each byte of a piece has the last token of its prefix.

Emission. Tokens still being read began within the longest token, so whatever the encodings of all prefixes that end there
agree on is settled: ``Transducer.tokens`` emits it each time it has read some multiple of that length, and holds no more
of a piece than its last bytes, however long the piece is.

Decoding. A table-driven UTF-8 machine (the well-formed sequences of the Unicode standard, table 3-7) takes bytes and gives
characters as they are complete; it runs over tokens by remembering what each does from the state between characters.

Defined results: a null or empty text has no tokens and the hash of the empty string; every other text, however long,
is encoded whole in time linear in its length; repeated rows are encoded each, an empty table gives no rows. Columns of
the input pass through, but those named like a new column are replaced.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import add_text_columns, keep_one

#: Pairs remembered before a fresh start, some 100 bytes each, so that memory stays bounded; states are no more than token prefixes.
MAX_PAIRS = 400_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.bytes_of = ranks, {v: k for k, v in ranks.items()}
        self.length = np.zeros(max(self.bytes_of) + 1, np.int64)
        for token, data in self.bytes_of.items():
            self.length[token] = len(data)
        self.lengths = self.length.tolist()
        self.longest = max(map(len, ranks))
        self.open = {token[:i] for token in ranks for i in range(1, len(token))}  # proper prefixes of tokens
        self.pairs: dict[int, dict] = {}  # token -> {the token before it: whether they may stand together}
        self.known = 0
        self.edges: dict[int, tuple] = {}
        self.reads: dict[tuple, tuple[tuple, dict]] = {}
        self.start = self.state(())

    def state(self, reads: tuple[bytes, ...]) -> tuple[tuple, dict]:
        """(reads, transitions) of a set of reads, all of them suffixes of the longest; built once, filled byte by byte."""
        if (known := self.reads.get(reads)) is None:
            known = self.reads[reads] = (reads, {})
        return known

    def history(self, token: int) -> tuple[bool, list, list]:
        """Whether the token's bytes merge to itself; and the parts at its right and left edge, from its last byte or first
        byte up to the token, each as (part, rank of the merge that ends it)."""
        if (known := self.edges.get(token)) is None:
            data = self.bytes_of[token]
            parts = [data[i : i + 1] for i in range(len(data))]
            left, right = [parts[0]], [parts[-1]]
            while len(parts) > 1:
                rank, i = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
                if rank == 1 << 60:
                    break
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                if i == 0:
                    left.append(parts[0])
                if i == len(parts) - 1:
                    right.append(parts[-1])
            ends = lambda spine: [(p, self.ranks[q]) for p, q in zip(spine, spine[1:])] + [(spine[-1], 1 << 60)]
            known = self.edges[token] = (len(parts) == 1, ends(right), ends(left))
        return known

    def follows(self, before: int | None, token: int) -> bool:
        """Whether ``token`` may stand after ``before`` (None: at the start): no merge crosses their border.

        Both sides' merges run by rank; the parts that touch the border at some time would merge if the rank of the two
        together comes before the merges that end either. At equal ranks the merge further left is first.
        """
        own, _, left = self.history(token)
        if not own or before is None:
            return own
        _, right, _ = self.history(before)
        i = j = 0
        while True:
            (a, a_ends), (b, b_ends) = right[i], left[j]
            across = self.ranks.get(a + b, 1 << 60)
            if across < a_ends and across <= b_ends and across < 1 << 60:
                return False
            if a_ends == b_ends == 1 << 60:
                return True
            if a_ends <= b_ends:
                i += 1
            else:
                j += 1

    def ask(self, before: int | None, token: int) -> bool:
        """``follows``, remembered."""
        self.known += 1
        if self.known > MAX_PAIRS:
            for table in self.pairs.values():
                table.clear()
            self.known = 0
        out = self.pairs[token][before] = self.follows(before, token)
        return out

    def step(self, state: tuple[tuple, dict], byte: int) -> tuple:
        """Build a transition: (next state, the tokens that can end with this byte as (token, length, its pairs))."""
        last = bytes((byte,))
        now = [read + last for read in (*state[0], b"")]
        ends = [(t, len(r), self.pairs.setdefault(t, {})) for r in now if (t := self.ranks.get(r)) is not None and self.history(t)[0]]
        out = state[1][byte] = (self.state(tuple(r for r in now if r in self.open)), ends)
        return out

    def settled(self, lasts: list, low: int) -> int:
        """The furthest place that the encodings of all prefixes ending after ``low`` go through; ``lasts`` has the last
        token of each prefix."""
        length = self.lengths
        places = set(range(low, len(lasts)))
        while len(places) > 1:
            at = max(places)
            places.discard(at)
            places.add(at - length[lasts[at]])
        return places.pop()

    def tokens(self, data: Iterable[int]) -> Iterator[list[int]]:
        """Tokens of the bytes of one piece, in parts, as soon as they are settled."""
        (reads, moves), lasts, at, full = self.start, [None], 0, 4 * self.longest
        first = None  # the last token emitted
        for byte in data:
            (reads, moves), ends = moves.get(byte) or self.step((reads, moves), byte)
            at += 1
            for k, (token, n, pairs) in enumerate(ends):
                before = lasts[at - n]
                known = pairs.get(before)
                if known or (known is None and self.ask(before, token)):
                    lasts.append(token)
                    if k:  # exactly one can follow; the likelier ones come to be asked first
                        ends[k - 1], ends[k] = ends[k], ends[k - 1]
                    break
            if at >= full and (cut := self.settled(lasts, at - self.longest)) > 0:
                yield self.back(lasts, cut)
                first = lasts[cut]
                del lasts[:cut]
                lasts[0] = first
                at -= cut
        yield self.back(lasts, at)

    def back(self, lasts: list, at: int) -> list[int]:
        """The tokens up to a place."""
        out, length = [], self.lengths
        while at > 0:
            token = lasts[at]
            out.append(token)
            at -= length[token]
        out.reverse()
        return out

    def piece(self, data: bytes) -> list[int]:
        """Token ids of one piece of the pattern."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        return [token for part in self.tokens(data) for token in part]


class ManyPieces:
    """The transducer run over many short pieces at once, byte by byte: its transitions as arrays, filled as texts take them.

    Answers about pairs are kept in a table of ``slots`` places, where a newer one takes the place of an older.
    """

    def __init__(self, fst: Transducer, slots: int = 1 << 20):
        self.fst, self.size, self.text = fst, len(fst.length) + 1, [*map(str, range(len(fst.length)))]
        self.keys, self.answers = np.full(slots, -1), np.zeros(slots, bool)
        self.numbers: dict[int, int] = {}
        self.states: list[tuple] = []
        self.moves = np.full((64, 256), -1, np.int32)  # [state, byte]: transition
        self.to = np.zeros(64, np.int32)
        self.ends, self.ways = np.full((64, 8, 2), -1, np.int32), 0  # [transition]: (token, length)s
        self.number(fst.start)

    def number(self, state: tuple) -> int:
        n = self.numbers.setdefault(id(state), len(self.states))
        if n == len(self.states):
            self.states.append(state)
            if n == len(self.moves):
                self.moves = np.concatenate([self.moves, np.full_like(self.moves, -1)])
        return n

    def build(self, state: int, byte: int) -> None:
        after, ends = self.states[state][1].get(byte) or self.fst.step(self.states[state], byte)
        if self.ways == len(self.to):
            self.to, self.ends = np.concatenate([self.to, self.to]), np.concatenate([self.ends, np.full_like(self.ends, -1)])
        if len(ends) > self.ends.shape[1]:
            self.ends = np.concatenate([self.ends, np.full_like(self.ends, -1)], axis=1)
        self.ends[self.ways, : len(ends)] = [(t, n) for t, n, _ in sorted(ends, key=lambda e: -e[1])]
        self.to[self.ways], self.moves[state, byte] = self.number(after), self.ways
        self.ways += 1

    def allowed(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether each token may stand after the one before it (-1: at the start)."""
        keys = (before.astype(np.int64) + 1) * self.size + token
        slot = (keys ^ (keys >> 17) * 31) % len(self.keys)
        new = self.keys[slot] != keys
        if not new.any():
            return self.answers[slot]
        out = self.answers[slot]
        some, at = np.unique(keys[new], return_inverse=True)
        found = np.array([self.fst.follows(b if b >= 0 else None, t) for b, t in zip((some // self.size - 1).tolist(), (some % self.size).tolist())], bool)
        out[new] = found[at]
        self.keys[slot[new]], self.answers[slot[new]] = keys[new], found[at]
        return out

    def __call__(self, pieces: list[bytes]) -> list[str]:
        """The decimal ids of each piece, joined by commas."""
        if not pieces:
            return []
        lengths = np.array([len(p) for p in pieces])
        order = np.argsort(-lengths, kind="stable")
        longest = int(lengths.max())
        data = np.zeros((len(pieces), longest), np.uint8)
        data[np.arange(longest) < lengths[:, None]] = np.frombuffer(b"".join(pieces), np.uint8)
        data, alive = data[order], np.searchsorted(lengths[order] * -1, -np.arange(longest), "left")
        state, lasts = np.zeros(len(pieces), np.int32), np.full((len(pieces), longest + 1), -1, np.int32)
        for at in range(longest):
            n = alive[at]
            way = self.moves[state[:n], data[:n, at]]
            if (way < 0).any():
                for pair in np.unique(state[:n][way < 0].astype(np.int64) << 8 | data[:n, at][way < 0]).tolist():
                    self.build(pair >> 8, pair & 255)
                way = self.moves[state[:n], data[:n, at]]
            open_, k = np.arange(n), 0
            while len(open_):
                token, size = self.ends[way[open_], k].T
                may = np.flatnonzero(token >= 0)
                good = may[self.allowed(lasts[open_[may], at + 1 - size[may]], token[may])]
                lasts[open_[good], at + 1] = token[good]
                left = np.ones(len(open_), bool)
                left[good] = False
                open_, k = open_[left], k + 1
            state[:n] = self.to[way]
        # back from each end: the last token, the one before it, and so on
        at, row, columns = lengths[order], np.arange(len(pieces)), []
        while at.any():
            token = lasts[row, at]
            columns.append(np.where(at > 0, token, -1))
            at = np.where(at > 0, at - self.fst.length[token], 0)
        out = [""] * len(pieces)
        text = self.text
        for i, tokens in zip(order.tolist(), np.stack(columns[::-1], 1).tolist()):
            out[i] = ",".join([text[t] for t in tokens if t >= 0])
        return out


class Encoder:
    """Texts to ids; ``pattern`` splits a text into the pieces that are encoded separately."""

    def __init__(self, path: str, pattern: str):
        self.fst = Transducer(load_ranks(path))
        self.machine = Utf8Tokens(self.fst.bytes_of)
        # the rank files' patterns mean Unicode's White_Space by \\s, without the ASCII separators that Python adds
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.many, self.known, self.older = ManyPieces(self.fst), {}, {}

    #: The pattern never joins a space with what stands before it if a character other than white space follows it.
    loose = re.compile(r" (?=[\s\x1c-\x1f]|$)")
    #: Longest piece, in bytes, that is encoded along with others; words remembered, some 250 bytes each, before the rarer go.
    long, most = 48, 60_000

    def joined(self, texts: list[str]) -> list[str]:
        """The decimal ids of each text, joined by commas."""
        # a text where spaces meet is cut as a whole, all others before each space; Arrow does so without Python strings
        cut = pc.split_pattern(pa.array([None if self.loose.search(t) else t for t in texts], pa.string()), " ")
        coded = cut.flatten().dictionary_encode()
        firsts = cut.offsets.to_numpy()[:-1][lengths := pc.fill_null(pc.list_value_length(cut), 0).to_numpy() > 0]
        codes, inner = coded.indices.to_numpy().copy(), coded.dictionary.to_pylist()
        codes[firsts] = len(inner) + np.arange(len(firsts))  # the first has no space before it
        ids = self.words([" " + w for w in inner] + [t[: t.find(" ") if " " in t else None] for t, live in zip(texts, lengths) if live], np.bincount(codes).tolist())
        lists = pa.ListArray.from_arrays(cut.offsets, pa.array(ids, pa.string()).take(pa.array(codes)))
        whole = self.words([t for t, live in zip(texts, lengths) if not live], None)
        out, whole = pc.binary_join(lists, ",").to_pylist(), iter(whole)
        return [(j[1:] if j[:1] == "," else j) if live else next(whole) for j, live in zip(out, lengths)]

    def words(self, found: list[str], times: list[int] | None) -> list[str]:
        """The joined ids of each word, which is cut by the pattern by itself; those of several ``times`` are remembered."""
        known, older, findall = self.known, self.older, self.pattern.findall
        out = [known.get(w) for w in found]
        again = [i for i, ids in enumerate(out) if ids is None]
        new = []
        for i in again:
            out[i] = older.get(found[i])
            if out[i] is None:
                new.append(i)
        cut = [(w,) if w.isascii() and (w.isalpha() or (w[:1] == " " and w[1:].isalpha())) else findall(w) for w in map(found.__getitem__, new)]
        ranks, made, short, data = self.fst.ranks, {}, [], []
        for piece in {p for c in cut for p in c}:
            part = piece.encode()
            if part in ranks:
                made[piece] = str(ranks[part])
            elif len(part) <= self.long:
                short.append(piece)
                data.append(part)
            else:
                made[piece] = ",".join(map(str, self.fst.piece(part)))
        made |= zip(short, self.many(data))
        for i, c in zip(new, cut):
            out[i] = made[c[0]] if len(c) == 1 else ",".join([made[p] for p in c])
        if len(known) > self.most:
            self.known, self.older = {}, known
        if times:
            self.known |= {w: out[i] for i in again if times[i] > 1 and len(w := found[i]) <= self.long}
        return out

    def ids_text(self, text: str) -> str:
        return self.joined([text])[0]

    def ids(self, text: str) -> np.ndarray:
        return ids_of(self.ids_text(text))


def ids_of(joined: str) -> np.ndarray:
    return np.fromstring(joined, np.int32, sep=",") if joined else np.zeros(0, np.int32)


def _utf8_table() -> list[list[int]]:
    """next[state][byte]; -1 rejects. 0: between characters; 1, 2, 3: so many continuation bytes are wanted; 4 to 7: after
    E0, ED, F0 and F4, whose second byte is narrower."""
    table = [[-1] * 256 for _ in range(8)]
    for state, low, high, then in ((0, 0x00, 0x7F, 0), (0, 0xC2, 0xDF, 1), (0, 0xE0, 0xE0, 4), (0, 0xE1, 0xEC, 2), (0, 0xED, 0xED, 5), (0, 0xEE, 0xEF, 2), (0, 0xF0, 0xF0, 6), (0, 0xF1, 0xF3, 3), (0, 0xF4, 0xF4, 7), (1, 0x80, 0xBF, 0), (2, 0x80, 0xBF, 1), (3, 0x80, 0xBF, 2), (4, 0xA0, 0xBF, 1), (5, 0x80, 0x9F, 1), (6, 0x90, 0xBF, 2), (7, 0x80, 0x8F, 2)):
        table[state][low : high + 1] = [then] * (high + 1 - low)
    return table


class Utf8Stream:
    """Incremental decoder: bytes in, characters out as soon as they are complete; at most three bytes are held back.

    A malformed sequence raises at its first wrong byte, as does ``close`` inside a character.
    """

    TABLE = _utf8_table()
    #: Of a lead byte, the bits that belong to the code point, by the bytes still wanted.
    LEAD = (0x7F, 0x1F, 0x0F, 0x07, 0x0F, 0x0F, 0x07, 0x07)

    def __init__(self):
        self.state = self.point = 0

    def push(self, data: bytes) -> str:
        out, table, state, point = [], self.TABLE, self.state, self.point
        for at, byte in enumerate(data):
            after = table[state][byte]
            if after < 0:
                raise UnicodeDecodeError("utf-8", data, at, at + 1, "malformed sequence")
            point = byte & self.LEAD[after] if state == 0 else point << 6 | byte & 0x3F
            if after == 0:
                out.append(chr(point))
            state = after
        self.state, self.point = state, point
        return "".join(out)

    def close(self) -> None:
        if self.state:
            raise UnicodeDecodeError("utf-8", b"", 0, 0, "unexpected end of data")


class Utf8Tokens:
    """The machine over tokens: what each token gives from the state between characters, where it ends there as well."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of, self.whole = bytes_of, {}
        for token, data in bytes_of.items():
            stream = Utf8Stream()
            try:
                chars = stream.push(data)
            except UnicodeDecodeError:
                continue  # begins inside a character
            if not stream.state:
                self.whole[str(token)] = chars

    def decode(self, joined: str, block: int = 1 << 16) -> Iterator[str]:
        """Characters of the decimal ids, block by block."""
        at, stream = 0, Utf8Stream()
        while at < len(joined):
            end = joined.find(",", at + block)
            end = len(joined) if end < 0 else end
            tokens = joined[at:end].split(",")
            at = end + 1
            if not stream.state:
                try:
                    yield "".join(map(self.whole.__getitem__, tokens))
                    continue
                except KeyError:
                    pass
            out = []
            for t in tokens:
                chars = None if stream.state else self.whole.get(t)
                out.append(stream.push(self.bytes_of[int(t)]) if chars is None else chars)
            yield "".join(out)
        stream.close()


#: Characters of texts that are encoded at once.
SLICE = 1 << 20


def encoder(path: str, pattern: str) -> Encoder:
    """Kept in its Python worker, as workers are reused between tasks."""
    return keep_one((path, pattern), lambda: Encoder(path, pattern))


def encode_ids(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Append ``ids`` (array of int): the whole text's tokens; a null text has none."""

    def make():
        enc = encoder(path, pattern)
        return lambda texts: {ids: [ids_of(j) for j in enc.joined([t or "" for t in texts])]}

    return add_text_columns(df, text, [T.StructField(ids, T.ArrayType(T.IntegerType()))], make, SLICE, keeps=True)


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Replace the text by n_tokens, ids_sha256, decoded_sha256 and round_trip (whether the decoded characters equal it)."""

    def make():
        enc = encoder(path, pattern)

        def run(texts: list) -> dict:
            out: dict = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "round_trip": []}
            for t, joined in zip(texts, enc.joined([t or "" for t in texts])):
                whole = t or ""
                sha, at, same = hashlib.sha256(), 0, True
                for chars in enc.machine.decode(joined):
                    sha.update(chars.encode())
                    same, at = same and whole.startswith(chars, at), at + len(chars)
                out["n_tokens"].append(joined.count(",") + 1 if joined else 0)
                out["ids_sha256"].append(hashlib.sha256(joined.encode()).hexdigest())
                out["decoded_sha256"].append(sha.hexdigest())
                out["round_trip"].append(same and at == len(whole))
            return out

        return run

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()), T.StructField("round_trip", T.BooleanType())]
    return add_text_columns(df, text, fields, make, SLICE, keep_text=False, keeps=True)
