"""Byte-level BPE by prefix dynamic programming, with exact appends and edits.

For every prefix of a byte string there is exactly one token that ends its
encoding. It is the token t for which the encoding of the shorter prefix
before t ends in a token that may stand next to t: two tokens may stand together
where no merge across their seam comes before the merges that build them. So
one pass over the places of a string, looking at the tokens that end there,
gives the last token of every prefix, and walking back from the end gives the
ids. The table of last tokens says more than the ids: appending goes on
where it ends, and an edit recomputes from its place on and stops when the
last tokens of as many places as the longest token has bytes are the old ones.

A text is split by the tokenizer's pattern and each match is encoded alone; a
match that is a token is that token. Between two white-space runs, texts are
cut into units (a space and the word after it, or white space) that no match
crosses. A slice of texts encodes each distinct unit that the worker's cache lacks
once, in order: neighbours share the table of what they begin with.

The vocabulary (a fixed file) is read on the driver; each token's last merge is
found there, and the tables are broadcast. Work is one pass without a
shuffle; a worker holds a bounded cache of units, and a few megabytes of texts, or one
longer text.

Defined cases: null text is empty and has no ids; rows with equal or null
``doc_id`` are encoded each on its own; special tokens' strings are ordinary
text; an empty table gives an empty result; only the named columns are used,
so other columns cannot clash. An edit with a null id, or of an unknown document, changes
nothing; several edits of a document are made by ``seq``, ties by place and
text; places beyond the text mean its end.
"""

from __future__ import annotations

import base64
import re
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.textkit import slices, workers_ready

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Units kept by one worker in each of two generations of two caches.
CACHE_UNITS = 150_000
#: Pairs of tokens whose seam has been looked at, kept by one worker.
CACHE_PAIRS = 400_000
_NEVER = 1 << 30

#: White space as the pattern's \s has it (Unicode's White_Space).
_SPACE = "\t-\r \x85\xa0  -     　"
#: Strings that a text with other white space than single spaces and line breaks
#: between other characters has, or begins or ends with.
_UNEVEN = ["  ", " \n", "\n ", "\n\n", *(chr(c) for c in range(0x3001) if c not in (10, 32) and re.match(f"[{_SPACE}]", chr(c)))]
_ENDS = ("", " ", "\n")
_UNIT = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


def ranks_of(path: str | None = None) -> dict[bytes, int]:
    """Token bytes to ids, from a rank file."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merged(data: bytes, ranks: dict[bytes, int], below: int = _NEVER) -> list[bytes]:
    """Plain byte-pair merging: the pair of least rank, leftmost first, as
    long as one has a rank under ``below``."""
    parts = [data[i:i + 1] for i in range(len(data))]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if rank >= below:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


def last_merges(ranks: dict[bytes, int]) -> np.ndarray:
    """Row t: the two tokens that merge into token t; (t, t) for a single byte,
    (-1, -1) for a token that merging never makes."""
    out = np.full((max(ranks.values()) + 1, 2), -1, np.int32)
    for token, rank in ranks.items():
        parts = [token, token] if len(token) == 1 else merged(token, ranks, rank)
        if len(parts) == 2:
            out[rank] = ranks[parts[0]], ranks[parts[1]]
    return out


class Vocabulary:
    """Tables of one rank file; pickled by its ranks and merges alone."""

    def __init__(self, ranks: dict[bytes, int], merges: np.ndarray | None = None):
        self.ranks = ranks
        self.merges = last_merges(ranks) if merges is None else merges
        self.token = [b""] * len(self.merges)
        for token, rank in ranks.items():
            self.token[rank] = token
        self.size = [len(t) for t in self.token]
        left, right = self.merges.T.tolist()
        self.longest = max(map(len, ranks))
        # Finds the tokens that end at a place, the longest first; bytes stand
        # as Latin-1 characters.
        self.found = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if left[rank] >= 0:
                self.found.add_word(token.decode("latin-1"), (len(token), rank))
        self.found.make_automaton()
        # Two tokens that make a token, as one number, with that token.
        self.across = {(ranks[token[:i]] << 16) | ranks[token[i:]]: rank for token, rank in ranks.items()
                       for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks}
        self.first_parts, self.last_parts = self._spines(left), self._spines(right)
        self.known: dict[int, bool] = {}

    def __reduce__(self):
        return Vocabulary, (self.ranks, self.merges)

    @staticmethod
    def _spines(side: list[int]) -> list[tuple[int, ...]]:
        """For each token the parts on one of its sides, from a byte up to it."""
        spines: list[tuple[int, ...]] = [()] * len(side)
        for token in sorted(range(len(side)), key=side.__getitem__):
            above = [token]
            while side[above[-1]] not in (above[-1], -1):
                above.append(side[above[-1]])
            spines[token] = (*reversed(above), _NEVER)
        return spines

    def together(self, pair: int) -> bool:
        """Whether merging the bytes of two tokens (a * 2**16 + b) gives the two
        again: replays what stands at their seam from the bytes up. A part lives
        until the merge into the next one of its spine; of merges of one rank
        the left comes first."""
        ends, begins = self.last_parts[pair >> 16], self.first_parts[pair & 0xFFFF]
        i = j = 0
        across, answer = self.across, True
        while True:
            x, y = ends[i + 1], begins[j + 1]
            made = across.get((ends[i] << 16) | begins[j], _NEVER)
            if made < x and made <= y:
                answer = False
                break
            if x <= y:
                if x == _NEVER:
                    break
                i += 1
            else:
                j += 1
        if len(self.known) >= CACHE_PAIRS:
            self.known.clear()
        self.known[pair] = answer
        return answer


def extend(v: Vocabulary, text: str, last, start: int, stop: int) -> None:
    """Appends to ``last`` the last tokens of the prefixes of ``text`` (bytes as
    Latin-1) up to ``stop``; ``last`` holds those of shorter prefixes, and no
    token that ends behind them begins before ``start``."""
    known, together, append = v.known.get, v.together, last.append
    done = len(last)
    for at, token_of in v.found.iter(text, start, stop):
        if at == done:  # the place's token is not known yet
            size, token = token_of
            if at >= size:
                pair = last[at - size] << 16 | token
                fits = known(pair)
                if fits is None:
                    fits = together(pair)
                if not fits:
                    continue
            append(token)
            done += 1


def walked_back(v: Vocabulary, last) -> list[int]:
    """The ids of a string, from its end, given the last token of each prefix."""
    out, at, size = [], len(last) - 1, v.size
    while at >= 0:
        token = last[at]
        out.append(token)
        at -= size[token]
    out.reverse()
    return out


class Prefixes:
    """The last token of every prefix of a byte string that is one match."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", array("i")
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self._extend(len(self.data))

    def _extend(self, stop: int) -> None:
        """Last tokens of the prefixes up to ``stop`` bytes."""
        done = len(self.last)
        extend(self.vocabulary, self.data.decode("latin-1"), self.last, max(0, done + 1 - self.vocabulary.longest), stop)

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Puts ``new`` in place of bytes start..end; returns how many last
        tokens were computed anew. Where as many places behind the edit as the
        longest token has bytes agree with the old ones, the rest does too."""
        old, shift, most = self.last, len(new) - (end - start), self.vocabulary.longest
        self.data = self.data[:start] + new + self.data[end:]
        self.last, behind = self.last[:start], start + len(new)
        while len(self.last) < len(self.data):
            self._extend(min(len(self.data), len(self.last) + most))
            done = len(self.last)
            if done >= behind + most and self.last[done - most:] == old[done - most - shift:done - shift]:
                self.last.extend(old[done - shift:])
                return done - start
        return len(self.data) - start

    def ids(self) -> list[int]:
        """Ids of the whole string."""
        whole = self.vocabulary.ranks.get(self.data)
        return walked_back(self.vocabulary, self.last) if whole is None else [whole]


def _pattern():
    import regex
    from public_tokenizers import PATTERN

    return regex.compile(PATTERN)


class Cache(dict):
    """Ids by unit, in two generations: a full one becomes the old one, whose
    units in use move back."""

    def __init__(self):
        self.old: dict[str, bytes] = {}

    def lacking(self, seen: set[str]) -> list[str]:
        """The units of ``seen`` that are in neither generation."""
        if len(self) >= CACHE_UNITS:
            self.old = dict(self)
            self.clear()
        out = []
        for unit in seen.difference(self):
            ids = self.old.get(unit)
            if ids is None:
                out.append(unit)
            else:
                self[unit] = ids
        return out


class Encoder:
    """Ids of texts (uint32 bytes), with bounded caches of units: as they are,
    and after a space."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.pattern = vocabulary, _pattern()
        self.plain, self.spaced = Cache(), Cache()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. The units that the caches lack are encoded
        together, once each."""
        cut, plain, spaced = [], {"\n"}, set()
        for text in texts:
            if text[:1] in _ENDS or text[-1] in _ENDS or any(x in text for x in _UNEVEN):
                units = _UNIT.findall(text)
                plain.update(units)
                cut.append((True, units))
            else:
                lines = [line.split(" ") for line in text.split("\n")]
                for words in lines:
                    plain.add(words[0])
                    spaced.update(words[1:])
                cut.append((False, lines))
        lacking = [(self.plain, u, u) for u in self.plain.lacking(plain)]
        lacking += [(self.spaced, u, " " + u) for u in self.spaced.lacking(spaced)]
        parts = [[u] if u.isalpha() or (u[:1] == " " and u[1:].isalpha()) else self.pattern.findall(u) for _, _, u in lacking]
        ids = self.match_ids({m for matches in parts for m in matches})
        for (cache, key, _), matches in zip(lacking, parts, strict=True):
            cache[key] = ids[matches[0]] if len(matches) == 1 else b"".join([ids[m] for m in matches])
        first, rest = self.plain.__getitem__, self.spaced.__getitem__
        line_break = first("\n")
        return [b"".join(map(first, x)) if uneven else line_break.join([first(words[0]) + b"".join(map(rest, words[1:])) for words in x])
                for uneven, x in cut]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def match_ids(self, matches: set[str]) -> dict[str, bytes]:
        """Ids of single matches, taken in order, so that one table serves them
        all: what a match shares with the one before stays, the rest is appended."""
        v, out = self.vocabulary, {}
        last: list[int] = []
        before = ""
        for text, match in sorted((m.encode().decode("latin-1"), m) for m in matches):
            whole = v.ranks.get(text.encode("latin-1"))
            if whole is not None:
                out[match] = array("I", (whole,)).tobytes()
                continue
            shared = 0
            for a, b in zip(before, text, strict=False):
                if a != b:
                    break
                shared += 1
            del last[shared:]
            extend(v, text, last, max(0, shared + 1 - v.longest), len(text))
            before = text
            out[match] = array("I", walked_back(v, last)).tobytes()
        return out


_encoders: dict[int, Encoder] = {}


def _encoder(vocabulary: Vocabulary) -> Encoder:
    """This worker's encoder for a broadcast vocabulary."""
    if id(vocabulary) not in _encoders:
        _encoders.clear()
        _encoders[id(vocabulary)] = Encoder(vocabulary)
    return _encoders[id(vocabulary)]


class EditedText:
    """A text whose matches keep their prefix tables, so that appends and edits
    encode anew only what stands near them."""

    #: A match's end may depend on so many characters behind it.
    AHEAD = 2

    def __init__(self, vocabulary: Vocabulary, text: str = ""):
        self.vocabulary, self.pattern = vocabulary, _pattern()
        self.text, self.starts, self.tables = "", [], []
        self.replace(0, 0, text)

    def append(self, more: str) -> int:
        return self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> int:
        """Puts ``new`` in place of characters start..end; returns how many
        last tokens were computed anew."""
        start, end = min(start, len(self.text)), min(max(start, end), len(self.text))
        shift = len(new) - (end - start)
        ends = [*self.starts[1:], len(self.text)][:len(self.starts)]
        first = int(np.searchsorted(np.array(ends, np.int64), start - self.AHEAD, "right"))
        at = self.starts[first] if first < len(self.starts) else len(self.text)
        old_at = {s + shift: i for i, s in enumerate(self.starts[first:], first) if s >= end}
        self.text = self.text[:start] + new + self.text[end:]
        starts, tables, work, rest = [], [], 0, len(self.starts)
        spare = {self.starts[i]: self.tables[i] for i in range(first, len(self.starts)) if self.starts[i] < end}
        for match in self.pattern.finditer(self.text, at):
            if match.start() >= start + len(new) and match.start() in old_at:
                rest = old_at[match.start()]
                break
            data, table = match.group().encode(), spare.pop(match.start(), None)
            if table is None:
                table = Prefixes(self.vocabulary, data)
                work += len(data)
            else:
                work += _reshaped(table, data)
            starts.append(match.start())
            tables.append(table)
        self.starts = [*self.starts[:first], *starts, *(s + shift for s in self.starts[rest:])]
        self.tables = [*self.tables[:first], *tables, *self.tables[rest:]]
        return work

    def ids(self) -> list[int]:
        return [i for t in self.tables for i in t.ids()]


def _reshaped(table: Prefixes, data: bytes) -> int:
    """Makes the table that of ``data``, by one edit between what both share."""
    old = table.data
    most = min(len(old), len(data))
    front = next((i for i in range(most) if old[i] != data[i]), most)
    back = next((i for i in range(most - front) if old[-1 - i] != data[-1 - i]), most - front)
    return table.replace(front, len(old) - back, data[front:len(data) - back])


def _broadcast(df: DataFrame, value):
    """Sends tables whose size is that of a fixed file."""
    workers_ready(df.sparkSession)
    return df.sparkSession.sparkContext.broadcast(value)


_ids_type = pa.list_(pa.int32())


def _id_lists(encoded: list[bytes]) -> pa.Array:
    offsets = np.cumsum([0, *(len(x) // 4 for x in encoded)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(encoded), np.int32)))


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids (array of int) of every document's text."""
    held = _broadcast(docs, Vocabulary(ranks_of(path)))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        encode_all = _encoder(held.value).encode_all
        for batch in batches:
            for ids, texts in slices(batch):
                lists = _id_lists(encode_all([t.decode("utf-8", "replace") for t in texts]))
                yield pa.RecordBatch.from_arrays([ids, lists], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, ids array<int>")


def decoded(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """The rows of ``tokens`` without ids but with decoded, their bytes."""
    held = _broadcast(tokens, sorted((rank, token) for token, rank in ranks_of(path).items()))
    rest = [f for f in tokens.schema if f.name != "ids"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest) + ", decoded binary"

    def run(batches):
        token = dict(held.value)
        for batch in batches:
            lists = batch.column("ids")
            flat, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            made = [b"".join([token[i] for i in flat[a:b].tolist()]) for a, b in zip(offsets, offsets[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in rest), pa.array(made, pa.binary())],
                                             names=[*(f.name for f in rest), "decoded"])

    return tokens.select(*(f.name for f in rest), "ids").mapInArrow(run, schema)


def reencoded(docs: DataFrame, edits: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text, ids and n_places of the documents that ``edits`` (doc_id,
    seq, start, stop, new: characters start..stop become ``new``) change.
    n_places counts the last tokens computed anew, besides the first encoding."""
    held = _broadcast(docs, Vocabulary(ranks_of(path)))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    steps = edits.filter("doc_id is not null and start is not null").groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("seq", F.lit(0)).cast("bigint").alias("seq"), F.col("start").cast("bigint").alias("start"),
                                             F.coalesce("stop", "start").cast("bigint").alias("stop"), F.coalesce("new", F.lit("")).alias("new")))).alias("steps"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(steps, "doc_id")

    def run(batches):
        for batch in batches:
            out = []
            for doc_id, text, todo in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "steps")), strict=True):
                table = EditedText(held.value, text)
                work = sum(table.replace(max(0, s["start"]), max(0, s["stop"]), s["new"]) for s in todo)
                out.append((doc_id, table.text, table.ids(), work))
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in out], batch.schema.field("doc_id").type), pa.array([r[1] for r in out], pa.string()),
                pa.array([r[2] for r in out], _ids_type), pa.array([r[3] for r in out], pa.int64())], names=["doc_id", "text", "ids", "n_places"])

    return rows.mapInArrow(run, f"doc_id {id_type}, text string, ids array<int>, n_places bigint")
