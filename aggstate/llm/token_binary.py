"""Token ids in binary shards, compressed by Re-Pair grammars.

Documents are put in ascending order of id by a range exchange, encoded, and cut into shards of about ``SHARD_TOKENS``
ids; a document never spans shards, however long it is.  Each shard gets its own grammar: frequent pairs of neighbouring
ids are replaced by nonterminals, round after round.  Pairs inside words come first, counted over the shard's distinct
words with their frequencies, then pairs across words over the whole sequence; the end id is never part of a pair, so
every document begins at a symbol.  In one round the most frequent pairs are replaced together; where two overlap, the
more frequent one wins.  Rounds go on until no pair stands ``LEAST_COUNT`` times any more (a rule takes the room of four
replacements, so rarer pairs gain little).  After its first round a phase looks only at places of pairs that were frequent
or that hold a new nonterminal: all other counts can but fall.

A shard is one binary value of a Parquet table (columns part, seq, n_docs, n_tokens, payload), written by Spark in the
shared folder, so it survives lost executors and can lie in any store.  Layout, little-endian: ``RPG1``, four u32
(documents, symbols, rules, first nonterminal), rules as u32 left ids, u32 right ids and u32 expansion lengths, document
ids as i64 (null: the smallest), first symbol of each document and the end as u64, first token likewise, then the
symbols' low 16 bits as u16 and their high bits as u8.  Expansion lengths allow decoding any range of ids without the
rest of the shard (``decode_range``).

Null and empty texts are the end id alone.  Null ids come first; of equal ids, rows are ordered by a hash of the text, and
repeated rows are encoded each.  Other columns don't matter.  An empty table writes no shard and gives no rows.

Encoding takes a short cut for texts of plain Latin letters: the tokenizer treats each piece that its own pattern finds
apart from all others, and none spans white space, so what stands between white space is encoded once by the library and
remembered (about ``CACHE`` entries, then afresh).  Arrow tells a shard's distinct words apart, so Python sees each once.
Every other text is given to the library whole.
"""

from __future__ import annotations

import functools
import gc
import itertools
import json
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrays_batch, blocks, shared_folder, string_buffer, table

END = 2
SHARD_TOKENS = 1_000_000
CACHE = 1_200_000
RULES_A_ROUND, LEAST_COUNT, LEAST_TAKEN = 4096, 8, 4
NO_ID = -(1 << 63)
_LETTERS = "a-zß-öø-ÿ"


def _byte_letters() -> dict[int, str]:
    """How a byte-level model writes the letters beyond ASCII that are read by the short cut: a character for each UTF-8 byte."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    of_byte = dict(zip(kept, map(chr, kept), strict=True)) | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in kept)}
    return {c: "".join(of_byte[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


#: Bytes of plain texts: tab, line ends, printable ASCII, and the lead and continuation bytes of U+00C0 to U+00FF.
_PLAIN = np.zeros(256, bool)
_PLAIN[[9, 10, 13, *range(0x20, 0x7F), *range(0x80, 0xC0), 0xC3]] = True


class Sequences:
    """Id sequences, one after another in one array that grows."""

    def __init__(self) -> None:
        self.n, self.flat, self.edges = 0, np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64)

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, k: int) -> np.ndarray:
        return self.flat[self.edges[k] : self.edges[k + 1]].astype(np.int64)

    def add(self, ids, sizes) -> None:
        at = int(self.edges[self.n])
        for name, wanted in (("flat", at + len(ids)), ("edges", self.n + len(sizes) + 1)):
            own = getattr(self, name)
            if wanted > len(own):
                setattr(self, name, np.concatenate([own, np.zeros(max(wanted - len(own), len(own)), own.dtype)]))
        self.flat[at : at + len(ids)] = ids
        self.edges[self.n + 1 : self.n + 1 + len(sizes)] = at + np.cumsum(sizes)
        self.n += len(sizes)

    def sizes(self, which: np.ndarray) -> np.ndarray:
        return self.edges[which + 1] - self.edges[which]

    def of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some sequences, joined, and their sizes."""
        n = self.sizes(which)
        ends = np.cumsum(n)
        return self.flat[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.edges[which] - ends + n, n)], n


class Encoder:
    """Ids of whole texts, as pieces: each text is an array of numbers of remembered id sequences."""

    def __init__(self, file: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(file)
        described = json.load(open(file, encoding="utf-8"))
        self.vocabulary = self.library.get_vocab_size(with_added_tokens=True)
        suffix = described["model"].get("end_of_word_suffix") or ""
        self.last = np.zeros(self.vocabulary, bool)
        if suffix:
            self.last[[i for t, i in self.library.get_vocab().items() if t.endswith(suffix)]] = True
        found = [p["pattern"]["Regex"] for p in (described.get("pre_tokenizer") or {}).get("pretokenizers", []) if p.get("type") == "Split" and "Regex" in p.get("pattern", {}) and p.get("invert")]
        kinds = [n.get("type") for n in (described.get("normalizer") or {}).get("normalizers", [])]
        self.bytes = [p.get("type") for p in (described.get("pre_tokenizer") or {}).get("pretokenizers", [])] == ["Split", "ByteLevel"]
        self.special = [t["content"] for t in described.get("added_tokens", [])]
        self.pieces = None
        if suffix and len(found) == 1 and kinds == ["NFC", "Replace", "Lowercase"]:
            plain = found[0]
            for name, own in ((r"[\p{L}]", f"[{_LETTERS}]"), (r"[\p{N}]", "[0-9]"), (r"\p{L}", _LETTERS), (r"\p{N}", "0-9")):
                plain = plain.replace(name, own)
            if r"\p" not in plain:
                self.pieces = re.compile(plain)
        self.fresh()

    def fresh(self) -> None:
        self.number: dict[str, int] = {"": -1}
        self.ids = Sequences()
        self.ids.add([END], [1])

    def odd_rows(self, column: pa.Array) -> np.ndarray:
        """Which rows hold more than plain Latin letters, ASCII and white space, or a special token."""
        data, offsets = string_buffer(column)
        if self.pieces is None:
            return np.diff(offsets) > 0
        raw = data[offsets[0] : offsets[-1]]
        odd = np.zeros(len(column), bool)
        sign = raw[:-1] == 0xC3
        sign &= (raw[1:] == 0x97) | (raw[1:] == 0xB7)  # U+00D7 and U+00F7 are no letters
        row_of = lambda at: np.searchsorted(offsets, at + offsets[0], "right") - 1
        odd[row_of(np.flatnonzero(~_PLAIN[raw]))] = True
        odd[row_of(np.flatnonzero(sign))] = True
        for token in self.special:
            head = np.frombuffer(token.encode()[:2], np.uint8)
            maybe = np.flatnonzero((raw[:-1] == head[0]) & (raw[1:] == head[-1])) if len(head) == 2 else np.flatnonzero(raw == head[0])
            for i in np.unique(row_of(maybe)).tolist():
                odd[i] = odd[i] or token in column[i].as_py()
        return odd

    def _remember(self, pieces: list[str], ids, sizes) -> None:
        self.number.update(zip(pieces, range(len(self.ids), len(self.ids) + len(pieces)), strict=True))
        self.ids.add(ids, sizes)

    def learn(self, chunks: list[str]) -> None:
        """Remembers the ids of new chunks; the library sees their new pieces parted by spaces, and its word ends part them again."""
        new = [c for c in chunks if c.isalpha()]  # letters alone are one piece
        mixed = list(set(chunks).difference(new))
        own = list(map(self.pieces.findall, mixed))
        flow = list(itertools.chain.from_iterable(own))
        new = list({p for p in flow if p not in self.number}.union(new))
        if self.bytes:  # a byte-level model reads ASCII letters as they are
            words = [p for p in new if p.isalpha()]
            tokenize, letters = self.library.model.tokenize, _byte_letters()
            found = [[t.id for t in tokenize(p if p.isascii() else p.translate(letters))] for p in words]
            self._remember(words, list(itertools.chain.from_iterable(found)), list(map(len, found)))
            new = [p for p in new if p not in self.number]
        for lo in range(0, len(new), 4096):
            some = new[lo : lo + 4096]
            got = np.array(self.library.encode(" ".join(some), add_special_tokens=False).ids, np.int64)
            ends = np.flatnonzero(self.last[got]) + 1
            if len(ends) == len(some) and ends[-1] == len(got):
                self._remember(some, got, np.diff(ends, prepend=0))
            else:  # a piece that is no word of its own when it stands alone
                found = [self.library.encode(p, add_special_tokens=False).ids for p in some]
                self._remember(some, list(itertools.chain.from_iterable(found)), list(map(len, found)))
        ids, sizes = self.ids.of(np.fromiter(map(self.number.__getitem__, flow), np.int64, len(flow)))
        edges = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(np.fromiter(map(len, own), np.int64, len(own))))]
        self._remember(mixed, ids, np.diff(edges))

    def encode(self, column: pa.Array | list[str | None]) -> list[np.ndarray]:
        """Numbers in self.ids for each text, 0 (the end) last."""
        texts = column = pa.array(column, pa.large_string()) if isinstance(column, list) else column.cast(pa.large_string())
        odd = self.odd_rows(column)
        if odd.any() or column.null_count:
            column = pc.if_else(pa.array(odd), pa.scalar("", pa.large_string()), column.fill_null(""))
        split = pc.ascii_split_whitespace(pc.utf8_lower(column))  # Arrow tells distinct words apart, Python sees each once
        coded = split.flatten().dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = list(map(self.number.get, names))
        if None in numbers:
            self.learn([c for c, n in zip(names, numbers, strict=True) if n is None])
            numbers = list(map(self.number.__getitem__, names))
        table = np.array(numbers, np.int64)
        flow = table[coded.indices.to_numpy()]
        row = np.repeat(np.arange(len(texts)), split.value_lengths().to_numpy())
        flow, row = flow[flow >= 0], row[flow >= 0]
        ends = np.cumsum(np.bincount(row, minlength=len(texts)) + 1 + odd)
        out = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
        out[np.arange(len(flow)) + (np.arange(len(texts)) + np.cumsum(odd))[row]] = flow
        for i in np.flatnonzero(odd).tolist():
            whole = self.library.encode(texts[i].as_py(), add_special_tokens=False).ids
            out[ends[i] - 2] = len(self.ids)
            self.ids.add(whole, [len(whole)])
        return np.split(out, ends[:-1])


@functools.cache
def encoder(file: str) -> Encoder:
    return Encoder(file)


class _Phase:
    """Replacement rounds over one sequence; pairs lie within one owner, and each owner counts weight times."""

    def __init__(self, sym: np.ndarray, owner: np.ndarray, weight: np.ndarray | None, base: int, rules: list[np.ndarray], least: int) -> None:
        self.sym, self.owner, self.weight, self.rules, self.least = sym.astype(np.int32), owner.astype(np.int32), weight, rules, least
        self.next = base + sum(map(len, rules))
        self.old = self.fresh = None  # by symbol: whether it is in a frequent pair, whether it came in the last round

    def run(self) -> tuple[np.ndarray, np.ndarray]:
        while self.round():
            pass
        return self.sym.astype(np.int64), self.owner.astype(np.int64)

    def places(self) -> np.ndarray:
        """Where pairs begin that may be frequent."""
        sym, owner = self.sym, self.owner
        if self.old is None:
            return np.flatnonzero((owner[:-1] == owner[1:]) & (sym[:-1] != END) & (sym[1:] != END))
        old, fresh = self.old[sym], self.fresh[sym]
        at = np.flatnonzero((old[:-1] & old[1:]) | fresh[:-1] | fresh[1:])
        return at[(owner[at] == owner[at + 1]) & (sym[at] != END) & (sym[at + 1] != END)]

    def round(self) -> bool:
        """Replaces the most frequent pairs and adds their rules; whether there were any."""
        sym, owner, least = self.sym, self.owner, self.least
        at = self.places()
        both = sym[at].astype(np.int64) << 32 | sym[at + 1]
        worth = None if self.weight is None else self.weight[owner[at]]
        bucket = ((both.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).view(np.int64)
        often = np.bincount(bucket, weights=worth, minlength=1 << 20)[bucket] >= least  # no pair of a rarer bucket is frequent enough
        at, both, worth = at[often], both[often], None if worth is None else worth[often]
        which, pairs = pd.factorize(both)
        counts = np.bincount(which, weights=worth, minlength=len(pairs))
        frequent = np.flatnonzero(counts >= least)
        if not len(frequent):
            return False
        chosen = frequent[np.lexsort((pairs[frequent], -counts[frequent]))][:RULES_A_ROUND]
        rank = np.full(len(pairs), len(chosen), np.int64)
        rank[chosen] = np.arange(len(chosen))
        own = rank[which]
        at, own = at[own < len(chosen)], own[own < len(chosen)]
        beside = np.diff(at) == 1
        before, behind = np.full(len(at), len(chosen)), np.full(len(at), len(chosen))
        before[1:][beside], behind[:-1][beside] = own[:-1][beside], own[1:][beside]
        won = (own <= before) & (own <= behind)
        take, own = at[won], own[won]
        row = np.arange(len(take))  # neighbouring places are repeats of one pair, of which every other one is taken
        some = (row - np.maximum.accumulate(np.where(np.append(True, np.diff(take) > 1), row, 0))) % 2 == 0
        take, own = take[some], own[some]
        taken = np.bincount(own, weights=None if self.weight is None else self.weight[owner[take]], minlength=len(chosen))
        good = taken >= LEAST_TAKEN  # others lose most of their places to more frequent ones
        good[0] = True
        some = good[own]
        take, own = take[some], own[some]
        used = np.flatnonzero(good)
        self.rules.append(np.stack([pairs[chosen[used]] >> 32, pairs[chosen[used]] & 0xFFFFFFFF], 1))
        after = self.next + len(used)
        self.old, self.fresh = np.zeros(after, bool), np.zeros(after, bool)
        self.old[pairs[frequent] >> 32] = self.old[pairs[frequent] & 0xFFFFFFFF] = True
        self.fresh[self.next :] = True
        sym[take] = (self.next + np.cumsum(good) - 1)[own]
        keep = np.ones(len(sym), bool)
        keep[take + 1] = False
        self.sym, self.owner, self.next = sym[keep], owner[keep], after
        return True


def repair(pieces: Sequences, texts: list[np.ndarray], base: int, *, least: int = LEAST_COUNT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grammar of texts (arrays of numbers of pieces): rules (left, right), symbols, and the first symbol of each text with the end."""
    flow = np.concatenate(texts) if texts else np.zeros(0, np.int64)
    counts = np.bincount(flow, minlength=1)
    present = np.flatnonzero(counts)
    number = np.zeros(len(counts), np.int64)
    number[present] = np.arange(len(present))
    flow, counts = number[flow], counts[present]
    sym, size = pieces.of(present)
    rules: list[np.ndarray] = []
    sym, owner = _Phase(sym, np.repeat(np.arange(len(present)), size), counts, base, rules, least).run()
    size = np.bincount(owner, minlength=len(present))
    start = np.cumsum(size) - size
    spans = size[flow]
    ends = np.cumsum(spans)
    total = int(ends[-1]) if len(ends) else 0
    sym = sym[np.arange(total) - np.repeat(ends - spans - start[flow], spans)]
    text_of = np.repeat(np.repeat(np.arange(len(texts)), [len(t) for t in texts]), spans)
    sym, text_of = _Phase(sym, text_of, None, base, rules, least).run()
    grammar = np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)
    return grammar, sym, np.searchsorted(text_of, np.arange(len(texts) + 1))


class Expansions:
    """Where each symbol's ids stand in one array: single ids by themselves, then every rule's whole expansion."""

    def __init__(self, rules: np.ndarray, base: int) -> None:
        lengths = np.concatenate([np.ones(base, np.int64), _lengths(rules, base)])
        flow = np.arange(base, base + len(rules))
        while len(flow) and (big := flow >= base).any():
            at = np.cumsum(big) - big + np.arange(len(flow))
            longer = np.empty(len(flow) + int(big.sum()), np.int64)
            longer[at[~big]] = flow[~big]
            rule = rules[flow[big] - base]
            longer[at[big]], longer[at[big] + 1] = rule[:, 0], rule[:, 1]
            flow = longer
        self.ids, self.lengths = np.concatenate([np.arange(base), flow]).astype(np.int32), lengths
        self.starts = np.cumsum(lengths) - lengths

    def of(self, sym: np.ndarray) -> np.ndarray:
        """The ids that symbols stand for."""
        n = self.lengths[sym]
        ends = np.cumsum(n)
        return self.ids[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[sym] - ends + n, n)]


def _lengths(rules: np.ndarray, base: int) -> np.ndarray:
    out = np.ones(len(rules), np.int64)
    # a rule's parts come from earlier rounds; a few passes settle all lengths
    while True:
        side = [np.where(rules[:, k] < base, 1, out[np.maximum(rules[:, k] - base, 0)]) for k in (0, 1)] if len(rules) else [out, out]
        if not len(rules) or np.array_equal(out, side[0] + side[1]):
            return out
        out = side[0] + side[1]


def pack(ids: list[int | None], pieces: Sequences, texts: list[np.ndarray], base: int) -> tuple[bytes, int]:
    """A shard's bytes and how many ids it holds."""
    rules, sym, first = repair(pieces, texts, base)
    lengths = _lengths(rules, base)
    size = np.ones(len(sym), np.int64)
    big = sym >= base
    size[big] = lengths[sym[big] - base]
    tokens = np.append(0, np.cumsum(size))[first]
    head = b"RPG1" + np.array([len(ids), len(sym), len(rules), base], "<u4").tobytes()
    body = [rules[:, 0].astype("<u4"), rules[:, 1].astype("<u4"), lengths.astype("<u4"), np.array([NO_ID if i is None else i for i in ids], "<i8"), first.astype("<u8"), tokens.astype("<u8"), (sym & 0xFFFF).astype("<u2"), (sym >> 16).astype("u1")]
    return head + b"".join(x.tobytes() for x in body), int(tokens[-1])


class Shard:
    """A shard's bytes, opened."""

    def __init__(self, payload: bytes) -> None:
        if payload[:4] != b"RPG1":
            raise ValueError("not a shard")
        docs, symbols, rules, self.base = np.frombuffer(payload, "<u4", 4, 4).tolist()
        at = 20
        parts = []
        for kind, n in (("<u4", rules), ("<u4", rules), ("<u4", rules), ("<i8", docs), ("<u8", docs + 1), ("<u8", docs + 1), ("<u2", symbols), ("u1", symbols)):
            parts.append(np.frombuffer(payload, kind, n, at))
            at += parts[-1].nbytes
        if at != len(payload):
            raise ValueError("a shard of the wrong size")
        left, right, self.lengths, self.ids, self.first, self.tokens, low, high = parts
        self.rules = np.stack([left, right], 1).astype(np.int64)
        self.symbols = low.astype(np.int64) | high.astype(np.int64) << 16

        self.expansions = Expansions(self.rules, self.base)

    def all(self) -> np.ndarray:
        return self.expansions.of(self.symbols)

    def document(self, k: int) -> np.ndarray:
        return self.expansions.of(self.symbols[int(self.first[k]) : int(self.first[k + 1])])

    def decode_range(self, lo: int, hi: int) -> np.ndarray:
        """The ids from place lo up to hi, expanding only the symbols that cover them."""
        size = np.ones(len(self.symbols), np.int64)
        big = self.symbols >= self.base
        size[big] = self.lengths[self.symbols[big] - self.base]
        ends = np.cumsum(size)
        a, b = np.searchsorted(ends, lo, "right"), np.searchsorted(ends, hi, "left") + 1
        before = int(ends[a - 1]) if a else 0
        return self.expansions.of(self.symbols[a:b])[lo - before : hi - before]


def write(df: DataFrame, folder: str, *, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = SHARD_TOKENS, cache: int = CACHE) -> None:
    """Writes df's texts as shards below folder; cache: remembered words a worker keeps."""
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")

    def run(batches):
        coder, part, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        ids: list = []
        texts: list[np.ndarray] = []
        held = 0

        def shard():
            nonlocal seq, ids, texts, held
            payload, tokens = pack(ids, coder.ids, texts, coder.vocabulary)
            row = arrays_batch({"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "n_docs": pa.array([len(ids)], pa.int64()), "n_tokens": pa.array([tokens], pa.int64()), "payload": pa.array([payload], pa.binary())})
            seq, ids, texts, held = seq + 1, [], [], 0
            if len(coder.ids) > cache:
                coder.fresh()
            return row

        gc.disable()  # millions of small lists, and no cycles among them
        try:
            for batch in batches:
                names, column = batch.column("id").to_pylist(), batch.column("text")
                for lo, hi in blocks(string_buffer(column)[1], 3 * shard_tokens):  # an id is about three bytes of text
                    own = coder.encode(column.slice(lo, hi - lo))
                    ids += names[lo:hi]
                    texts += own
                    held += int(coder.ids.sizes(np.concatenate(own)).sum())
                    if held >= 0.75 * shard_tokens:
                        yield shard()
            if ids:
                yield shard()
        finally:
            gc.enable()
            pa.default_memory_pool().release_unused()

    rows.mapInArrow(run, "part int, seq int, n_docs bigint, n_tokens bigint, payload binary").write.option("compression", "zstd").parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32, part, seq) for each document of the shards below folder, from their bytes."""
    shards = spark.read.parquet(folder)

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                shard = Shard(batch.column("payload")[k].as_py())
                raw, edges = shard.all().astype("<u4"), shard.tokens.astype(np.int64)
                bounds = edges.tolist()
                sums = [zlib.crc32(raw[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                n = len(sums)
                yield arrays_batch({"part": pa.array([batch.column("part")[k].as_py()] * n, pa.int32()), "seq": pa.array([batch.column("seq")[k].as_py()] * n, pa.int32()), "id": pa.array(shard.ids.astype(np.int64), mask=shard.ids == NO_ID), "own": edges[:-1], "n_tokens": np.diff(edges), "ids_crc32": np.array(sums, np.int64)})

    docs = shards.select("part", "seq", "payload").mapInArrow(run, "part int, seq int, id bigint, own bigint, n_tokens bigint, ids_crc32 bigint")
    sizes = shards.select("part", "seq", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(parts, "part").selectExpr("part", "seq", "base + before AS offset")
    return docs.join(starts, ["part", "seq"]).selectExpr("id", "offset + own AS start", "n_tokens", "ids_crc32", "part", "seq")


def tokenizer_file() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def encoded(spark: SparkSession, docs: DataFrame, **sizes: int) -> DataFrame:
    folder = shared_folder(spark, "token-shards")
    write(docs, folder, tokenizer=tokenizer_file(), **sizes)
    return read(spark, folder).select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op3_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(spark, table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As the query, with half as large shards and fewer remembered words: a worker's memory holds what earlier stages left as well.
    Null and empty texts are the end id alone; repeated rows are encoded each."""
    return encoded(spark, docs, shard_tokens=SHARD_TOKENS // 2, cache=CACHE // 8)


QUERIES = {"op3_token_binary": op3_token_binary}
