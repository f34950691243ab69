"""Interpolated modified Kneser-Ney n-gram model of order two or three, counted in Spark and stored as sorted hash arrays.

Words are numbered by the rank of their 64-bit hash among all training words.
Counting packs what a batch has gathered into arrays per shard, so a shuffle
row holds many counts; a shard merges its arrays, sorts them and writes them to
the shared folder. Scoring tasks memory-map the arrays and look words and
bigrams up by binary search.

A bigram goes to a shard by its first word, but a word with many occurrences is
split over several shards by the second word, so no shard depends on how common
a word is. Bigram keys are two 32-bit word numbers.

Order three counts trigrams and keeps, for bigrams, the number of different
words before them instead of their occurrences; all else is the same. Trigrams
and their contexts are keyed by 64-bit hashes of word numbers. A trigram goes
to a shard by its context, a context that may be common (no more often than its
rarer word) is split by the third word, and what is known of a context is summed
in a shard of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_array, scratch, write_file

END = b" "                      # the end token: no word can be a space
WORD_SHARD_BYTES, PAIR_SHARD_BYTES = 256 << 20, 16 << 20   # training text for each shard of words and of bigrams
SPLIT = 500_000                 # occurrences of a first word for each of its shards
GATHER = 1_500_000              # tokens or different words gathered before they are passed on
CACHE = 700_000                 # words whose number a worker remembers
OPEN = 128                      # arrays of each kind a worker keeps mapped


def tokens(text: str | None) -> list[bytes]:
    """Lower-case (A-Z) words of a text and the end token."""
    words = text.encode().lower().split() if text else []
    words.append(END)
    return words


def mix(x):
    """A bijective scrambling of 64-bit numbers."""
    import numpy as np
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_shard(hashes, shards: int):
    """Shards of consecutive hashes."""
    import numpy as np
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def pair_shard(first, second, first_count, shards: int):
    import numpy as np
    parts = 1 + first_count // SPLIT
    sub = mix(second.astype(np.uint64) + np.uint64(0x9E3779B9)) % parts.astype(np.uint64)
    return (mix(first.astype(np.uint64) * np.uint64(0x10001) + sub * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(shards)).astype(np.int64)


def chain(first, *others):
    """64-bit hashes of runs of word numbers, one array per place."""
    import numpy as np
    h = mix(first.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
    for x in others:
        h = mix(h + x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return h


def triple_shard(context, third, context_most, shards: int):
    """Shards of trigrams; ``context_most`` bounds the occurrences of their contexts."""
    import numpy as np
    sub = mix(third.astype(np.uint64) + np.uint64(0x51ED270B)) % (1 + context_most // SPLIT).astype(np.uint64)
    return (mix(context + sub * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(shards)).astype(np.int64)


def merge(keys, counts):
    """Sorted different keys and their summed counts."""
    import numpy as np
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _packed(shards, *columns):
    """Rows (shard, column bytes ...) of arrays cut by shard; the arrays come sorted by shard."""
    import numpy as np
    different, start = np.unique(shards, return_index=True)
    end = np.append(start[1:], len(shards))
    return [(int(s), *(c[a:b].tobytes() for c in columns)) for s, a, b in zip(different, start, end)]


def _batch(rows, names):
    import pyarrow as pa
    kinds = [pa.int32()] + [pa.binary()] * (len(names) - 1)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _joined(column, dtype):
    import numpy as np
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


@dataclass(frozen=True)
class Lexicon:
    """The words: arrays by shard of hashes; sizes and first numbers of the shards."""

    uri: str
    sizes: tuple[int, ...]

    @property
    def bases(self):
        import numpy as np
        return np.append(0, np.cumsum(self.sizes)).astype(np.int64)

    def array(self, name: str, shard: int, dtype):
        return map_array(f"{self.uri}/words-{shard:06d}.{name}", dtype)

    def column(self, name: str, dtype):
        return Column(self, name, dtype)


class Open(dict):
    """Mapped arrays by shard: the ones used last, ``OPEN`` of them at most, so that a worker's maps do not grow with the
    model. A missing one is opened by ``load``."""

    def __init__(self, load):
        self.load = load

    def __getitem__(self, shard):
        found = self.pop(shard, None)
        if found is None:
            found = self.load(shard)
            while len(self) >= OPEN:
                del self[next(iter(self))]
        self[shard] = found   # the last one now
        return found


class Column:
    """Values by word number, read from the shards' arrays."""

    def __init__(self, lexicon: Lexicon, name: str, dtype):
        self.dtype, self.open = dtype, Open(lambda s: lexicon.array(name, s, dtype))
        self.bases = lexicon.bases

    def __getitem__(self, numbers):
        import numpy as np
        out = np.zeros(len(numbers), self.dtype)
        shard = np.searchsorted(self.bases, numbers, side="right") - 1
        for s in np.unique(shard):
            at = shard == s
            out[at] = self.open[s][numbers[at] - self.bases[s]]
        return out


class Numbering:
    """Word numbers of lists of words; -1 for words not in the lexicon. Remembers a bounded number of words."""

    def __init__(self, lexicon: Lexicon):
        import numpy as np
        self.lexicon, self.bases, self.known = lexicon, lexicon.bases, {}
        self.open = Open(lambda s: lexicon.array("hash", s, np.uint64))

    def find(self, hashes):
        import numpy as np
        out = np.full(len(hashes), -1, np.int64)
        shard = word_shard(hashes, len(self.lexicon.sizes))
        for s in np.unique(shard):
            if not self.lexicon.sizes[s]:
                continue
            array, at = self.open[s], np.flatnonzero(shard == s)
            place = np.minimum(np.searchsorted(array, hashes[at]), len(array) - 1)
            hit = array[place] == hashes[at]
            out[at[hit]] = place[hit] + self.bases[s]
        return out

    def __call__(self, words: list[bytes]):
        import numpy as np
        from xxhash import xxh64_intdigest
        got = list(map(self.known.get, words))
        missing = [i for i, v in enumerate(got) if v is None]
        if missing:
            if len(self.known) > CACHE:
                self.known.clear()
            new = list(dict.fromkeys(words[i] for i in missing))
            fresh = dict(zip(new, self.find(np.fromiter(map(xxh64_intdigest, new), np.uint64, len(new))).tolist()))
            self.known.update(fresh)
            for i in missing:
                got[i] = fresh[words[i]]
        return np.array(got, np.int64)


@dataclass(frozen=True)
class Model:
    """Where the arrays lie, and the totals the formulas need."""

    lexicon: Lexicon
    pair_shards: int
    train_tokens: int
    pairs: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    word_classes: tuple[int, int, int]   # words with 1, 2, 3 or more different words before them
    order: int = 2
    triple_discounts: tuple[float, float, float] = (0.75,) * 3

    @property
    def words(self) -> int:
        return sum(self.lexicon.sizes)


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of counts 1 to 4; 0.75 each where those are too few."""
    if not (n1 and n2 and n3):
        return 0.75, 0.75, 0.75
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.05), float(k)) for k, d in enumerate(found, 1))


def train(docs: DataFrame, *, text_col: str = "text", order: int = 2) -> Model:
    """Count the texts and write the model's arrays to the shared folder. ``order`` is 2 or 3.

    Null and empty texts are one end token. No rows give a model without words,
    under which every text has probability 1.
    """
    if order not in (2, 3):
        raise ValueError("the order must be 2 or 3")
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    word_shards, pair_shards = 1 + size // WORD_SHARD_BYTES, 1 + size // PAIR_SHARD_BYTES
    uri = scratch(spark, "lm")

    def count_words(batches):
        import numpy as np
        from collections import Counter
        from xxhash import xxh64_intdigest
        seen: Counter = Counter()

        def passed_on():
            h = np.fromiter(map(xxh64_intdigest, seen), np.uint64, len(seen))
            n = np.fromiter(seen.values(), np.uint64, len(seen))
            order = np.argsort(h)
            seen.clear()
            return _batch(_packed(word_shard(h[order], word_shards), h[order], n[order]), ["shard", "hash", "count"])

        for b in batches:
            for t in b.column("text").to_pylist():
                seen.update(tokens(t))
                if len(seen) > GATHER // 4:
                    yield passed_on()
        if seen:
            yield passed_on()

    def write_words(t):
        import numpy as np
        import pyarrow as pa
        s = t.column("shard")[0].as_py()
        h, n = merge(_joined(t.column("hash"), np.uint64), _joined(t.column("count"), np.uint64))
        write_file(f"{uri}/words-{s:06d}.hash", [h.tobytes()])
        write_file(f"{uri}/words-{s:06d}.count", [n.tobytes()])
        return pa.table({"shard": pa.array([s], pa.int32()), "words": pa.array([len(h)], pa.int64()),
                         "tokens": pa.array([int(n.sum())], pa.int64())})

    packed = texts.mapInArrow(count_words, "shard int, hash binary, count binary")
    # One row per 256 MB of training text.
    written = {r["shard"]: r for r in packed.groupBy("shard").applyInArrow(write_words, "shard int, words long, tokens long").collect()}
    lexicon = Lexicon(uri, tuple(written[s]["words"] if s in written else 0 for s in range(word_shards)))
    n_tokens = sum(r["tokens"] for r in written.values())
    if sum(lexicon.sizes) >= 1 << 32:
        raise ValueError("more than 2^32 different words")
    if not written:
        return Model(lexicon, pair_shards, 0, 0, (0.75,) * 3, (0.75,) * 3, (0, 0, 0), order)

    def count_runs(batches):
        """Packed bigrams or trigrams of the texts."""
        import numpy as np
        numbering, counts = Numbering(lexicon), lexicon.column("count", np.uint64)
        end = numbering([END])
        held: list = []
        total = 0

        def passed_on():
            if order == 3:
                a, b, c = (np.concatenate(x) for x in zip(*held))
                held.clear()
                _, at, n = np.unique(chain(a, b, c), return_index=True, return_counts=True)
                a, b, c = a[at], b[at], c[at]
                most = np.minimum(_values(counts, a), _values(counts, b))
                shard = triple_shard(chain(a, b), c, most, pair_shards)
                by = np.argsort(shard, kind="stable")
                return _batch(_packed(shard[by], *(x[by].astype(np.uint32) for x in (a, b, c, n))), ["shard", "a", "b", "c", "count"])
            key, n = np.unique(np.concatenate(held), return_counts=True)
            first, second = key >> np.uint64(32), key & np.uint64(0xFFFFFFFF)
            different, of = np.unique(first, return_inverse=True)
            shard = pair_shard(first, second, counts[different.astype(np.int64)][of], pair_shards)
            by = np.argsort(shard, kind="stable")
            held.clear()
            return _batch(_packed(shard[by], key[by], n[by].astype(np.uint32)), ["shard", "key", "count"])

        for b in batches:
            words: list[bytes] = []
            for t in b.column("text").to_pylist():
                words += tokens(t)
                if len(words) > GATHER:
                    held.append(runs(numbering(words), end))
                    total += len(words)
                    words = []
                    yield passed_on()
                    total = 0
            if words:
                held.append(runs(numbering(words), end))
                total += len(words)
            if total > GATHER:
                yield passed_on()
                total = 0
        if held:
            yield passed_on()

    def write_triples(t):
        """Write a shard's trigrams; give on bigrams with their different words before, sums of contexts, and classes."""
        import numpy as np
        import pyarrow as pa
        s = t.column("shard")[0].as_py()
        a, b, c, n = (_joined(t.column(x), np.uint32) for x in ("a", "b", "c", "count"))
        key = chain(a, b, c)
        by = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.append(True, key[by][1:] != key[by][:-1]))
        n = np.add.reduceat(n[by].astype(np.int64), first)
        key, a, b, c = (x[by][first] for x in (key, a, b, c))
        write_file(f"{uri}/triples-{s:06d}.key", [key.tobytes()])
        write_file(f"{uri}/triples-{s:06d}.count", [n.astype(np.uint32).tobytes()])
        counts = lexicon.column("count", np.uint64)
        rows = [(-1, b"", np.array([(n == k).sum() for k in (1, 2, 3, 4)] + [len(n)], np.int64).tobytes())]
        context = chain(a, b)
        by = np.argsort(context, kind="stable")
        start = np.flatnonzero(np.append(True, context[by][1:] != context[by][:-1]))
        after = np.stack([np.add.reduceat(x[by].astype(np.int64), start) for x in (n, n == 1, n == 2, n >= 3)], axis=1)
        context = context[by][start]
        shard = (context % np.uint64(pair_shards)).astype(np.int64)
        by = np.argsort(shard, kind="stable")
        rows += [(2 * w + 1, k, v) for w, k, v in _packed(shard[by], context[by], after[by])]
        pair, before = np.unique(b.astype(np.uint64) << np.uint64(32) | c.astype(np.uint64), return_counts=True)
        b, c = pair >> np.uint64(32), pair & np.uint64(0xFFFFFFFF)
        shard = pair_shard(b, c, _values(counts, b), pair_shards)
        by = np.argsort(shard, kind="stable")
        rows += [(2 * w, k, v) for w, k, v in _packed(shard[by], pair[by], before[by].astype(np.uint32))]
        return pa.Table.from_batches([_batch(rows, ["shard", "key", "count"])])

    def write_contexts(t):
        """A shard of bigrams (even), of contexts of trigrams (odd, nothing to give on), or the trigrams' classes (-1)."""
        import numpy as np
        import pyarrow as pa
        s = t.column("shard")[0].as_py()
        if s < 0:
            rows = [(-2, np.zeros(1, np.int64).tobytes(), v) for v in t.column("count").to_pylist()]
            return pa.Table.from_batches([_batch(rows, ["shard", "ids", "values"])])
        key = _joined(t.column("key"), np.uint64)
        if s % 2 == 0:
            return write_pairs(s // 2, key, _joined(t.column("count"), np.uint32))
        after = _joined(t.column("count"), np.int64).reshape(-1, 4)
        by = np.argsort(key, kind="stable")
        start = np.flatnonzero(np.append(True, key[by][1:] != key[by][:-1]))
        write_file(f"{uri}/contexts-{s // 2:06d}.key", [key[by][start].tobytes()])
        write_file(f"{uri}/contexts-{s // 2:06d}.after", [np.add.reduceat(after[by], start, axis=0).tobytes()])
        return pa.schema([("shard", pa.int32()), ("ids", pa.binary()), ("values", pa.binary())]).empty_table()

    def write_pair_rows(t):
        import numpy as np
        return write_pairs(t.column("shard")[0].as_py(), _joined(t.column("key"), np.uint64), _joined(t.column("count"), np.uint32))

    def write_pairs(s, key, n):
        import numpy as np
        import pyarrow as pa
        key, n = merge(key, n.astype(np.uint64))
        write_file(f"{uri}/pairs-{s:06d}.key", [key.tobytes()])
        write_file(f"{uri}/pairs-{s:06d}.count", [n.astype(np.uint32).tobytes()])
        first, second = (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
        start = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
        after = np.stack([np.add.reduceat(x.astype(np.int64), start) for x in (n, n == 1, n == 2, n >= 3)], axis=1)
        ids, before = np.unique(second, return_counts=True)
        classes = np.array([[(n == k).sum() for k in (1, 2, 3, 4)] + [len(n)]], np.int64)
        rows = [(-1, np.zeros(1, np.int64).tobytes(), classes.tobytes())]
        for numbers, values, kind in ((first[start], after, 0), (ids, before.astype(np.uint32), 1)):
            shard = np.searchsorted(lexicon.bases, numbers, side="right") - 1
            rows += [(2 * w + kind, a, v) for w, a, v in _packed(shard, (numbers - lexicon.bases[shard]).astype(np.uint32), values)]
        return pa.Table.from_batches([_batch(rows, ["shard", "ids", "values"])])

    def write_statistics(t):
        import numpy as np
        import pyarrow as pa
        s = t.column("shard")[0].as_py()
        if s < 0:
            totals = _joined(t.column("values"), np.int64).reshape(-1, 5).sum(axis=0)
        elif s % 2 == 0:
            after = np.zeros((lexicon.sizes[s // 2], 4), np.int64)
            for ids, values in zip(t.column("ids").to_pylist(), t.column("values").to_pylist()):
                # A word split over shards comes from each of them; in one row every word is there once.
                after[np.frombuffer(ids, np.uint32)] += np.frombuffer(values, np.int64).reshape(-1, 4)
            write_file(f"{uri}/words-{s // 2:06d}.after", [after.tobytes()])
            totals = np.zeros(5, np.int64)
        else:
            before = np.zeros(lexicon.sizes[s // 2], np.uint32)
            for ids, values in zip(t.column("ids").to_pylist(), t.column("values").to_pylist()):
                before[np.frombuffer(ids, np.uint32)] += np.frombuffer(values, np.uint32)
            write_file(f"{uri}/words-{s // 2:06d}.before", [before.tobytes()])
            totals = np.array([(before == k).sum() for k in (1, 2, 3, 4)] + [(before >= 3).sum()], np.int64)
        return pa.table({"shard": pa.array([s], pa.int32()), "totals": pa.array([totals.tolist()], pa.list_(pa.int64()))})

    runs = _pairs if order == 2 else _triples
    if order == 2:
        packed = texts.mapInArrow(count_runs, "shard int, key binary, count binary")
        written_pairs = packed.groupBy("shard").applyInArrow(write_pair_rows, "shard int, ids binary, values binary")
    else:
        packed = texts.mapInArrow(count_runs, "shard int, a binary, b binary, c binary, count binary")
        written_pairs = packed.groupBy("shard").applyInArrow(write_triples, "shard int, key binary, count binary") \
            .groupBy("shard").applyInArrow(write_contexts, "shard int, ids binary, values binary")
    gathered = written_pairs.groupBy("shard").applyInArrow(write_statistics, "shard int, totals array<bigint>").collect()
    pair_classes = next(r["totals"] for r in gathered if r["shard"] == -1)
    triple_classes = next((r["totals"] for r in gathered if r["shard"] == -2), [0] * 5)
    words = [sum(x) for x in zip(*(r["totals"] for r in gathered if r["shard"] % 2 == 1 and r["shard"] > 0))]
    return Model(lexicon, pair_shards, n_tokens, pair_classes[4], discounts(*pair_classes[:4]), discounts(*words[:4]),
                 (words[0], words[1], words[4]), order, discounts(*triple_classes[:4]))


def _values(column, numbers):
    """A column's values for word numbers that repeat."""
    import numpy as np
    different, of = np.unique(numbers.astype(np.int64), return_inverse=True)
    return column[different][of]


def _triples(numbers, end):
    """Runs of three tokens; two end tokens stand before the first. A text begins after an end token."""
    import numpy as np
    before = np.concatenate([end, numbers[:-1]])
    earlier = np.concatenate([end, before[:-1]])
    return np.where(before == end[0], end[0], earlier), before, numbers


def _pairs(numbers, end):
    """Keys of all neighbouring tokens; an end token stands before the first."""
    import numpy as np
    before = np.concatenate([end, numbers[:-1]]).astype(np.uint64)
    return before << np.uint64(32) | numbers.astype(np.uint64)


class Scorer:
    """Log probabilities of token lists under a model, from its memory-mapped arrays."""

    def __init__(self, model: Model):
        import numpy as np
        self.m, self.numbering = model, Numbering(model.lexicon)
        self.count, self.before = model.lexicon.column("count", np.uint64), model.lexicon.column("before", np.uint32)
        self.after = Open(lambda s: model.lexicon.array("after", s, np.int64).reshape(-1, 4))
        self.bases = model.lexicon.bases
        self.pairs = Open(lambda s: self._arrays("pairs", s, "count", np.uint32))
        self.triples = Open(lambda s: self._arrays("triples", s, "count", np.uint32))
        self.contexts = Open(lambda s: self._arrays("contexts", s, "after", np.int64))

    def _arrays(self, kind: str, shard: int, values: str, dtype):
        import numpy as np
        names = (f"{self.m.lexicon.uri}/{kind}-{shard:06d}.{x}" for x in ("key", values))
        try:
            key, found = (map_array(x, d) for x, d in zip(names, (np.uint64, dtype)))
        except FileNotFoundError:   # nothing fell into this shard
            key, found = np.empty(0, np.uint64), np.empty(0, dtype)
        return key, found.reshape(len(key), -1)

    def look_up(self, arrays: Open, keys, shard, width: int = 1):
        """Rows of values by key, from the shards that may hold them; zeros where there are none."""
        import numpy as np
        out = np.zeros((len(keys), width))
        order = np.argsort(shard, kind="stable")
        edges = np.searchsorted(shard[order], np.arange(self.m.pair_shards + 1))
        for s in np.flatnonzero(np.diff(edges)):
            there, values = arrays[s]
            at = order[edges[s]:edges[s + 1]]
            if len(there):
                place = np.minimum(np.searchsorted(there, keys[at]), len(there) - 1)
                hit = there[place] == keys[at]
                out[at[hit]] = values[place[hit]]
        return out

    def followers(self, numbers):
        """Per word: tokens after it, and how many different words follow once, twice, more often."""
        import numpy as np
        out = np.zeros((len(numbers), 4))
        shard = np.searchsorted(self.bases, numbers, side="right") - 1
        for s in np.unique(shard):
            at = shard == s
            out[at] = self.after[s][numbers[at] - self.bases[s]]
        return out

    def pair_counts(self, first, second, first_count):
        import numpy as np
        key = first.astype(np.uint64) << np.uint64(32) | second.astype(np.uint64)
        return self.look_up(self.pairs, key, pair_shard(first, second, first_count, self.m.pair_shards))[:, 0]

    def with_two_words(self, ids, start, lower):
        """p(w) after two words, from the probabilities after one; those stand where the two words are unseen."""
        import numpy as np
        m = self.m
        end = self.numbering([END])[0]
        before = np.roll(ids, 1)
        before[start] = end
        earlier = np.roll(before, 1)
        earlier[start] = end
        at = np.flatnonzero((before >= 0) & (earlier >= 0))
        a, b, c = earlier[at], before[at], ids[at]
        contexts, first, of = np.unique(chain(a, b), return_index=True, return_inverse=True)
        after = self.look_up(self.contexts, contexts, (contexts % np.uint64(m.pair_shards)).astype(np.int64), 4)
        total, left = after[:, 0], after[:, 1:] @ np.array(m.triple_discounts)
        known = c >= 0
        triples, place, back = np.unique(chain(a[known], b[known], c[known]), return_index=True, return_inverse=True)
        most = np.minimum(_values(self.count, a[known][place]), _values(self.count, b[known][place]))
        shard = triple_shard(contexts[of[known][place]], c[known][place], most, m.pair_shards)
        n = np.zeros(len(at))
        n[known] = self.look_up(self.triples, triples, shard)[back, 0]
        d = np.array((0.0, *m.triple_discounts))
        p = lower.copy()
        seen = total[of] > 0
        whole = np.maximum(total[of], 1)
        p[at] = np.where(seen, np.maximum(n - d[np.minimum(n, 3).astype(np.int64)], 0) / whole + left[of] / whole * lower[at], lower[at])
        return p

    def word_probability(self, before):
        """p(w) from the number of different words seen before w; the rest is spread over all words and one unknown."""
        import numpy as np
        m = self.m
        if not m.pairs:
            return np.full(len(before), 1 / (m.words + 1))
        d = np.array((0.0, *m.word_discounts))
        rest = sum(a * b for a, b in zip(m.word_discounts, m.word_classes)) / m.pairs
        return np.maximum(before - d[np.minimum(before, 3).astype(np.int64)], 0) / m.pairs + rest / (m.words + 1)

    def __call__(self, words: list[bytes], sizes):
        """(known, base, score) sums for each run of tokens of the given sizes."""
        import numpy as np
        m = self.m
        ids = self.numbering(words)
        start = np.append(0, np.cumsum(sizes))[:-1]
        different, of = np.unique(ids, return_inverse=True)
        there = different >= 0
        known = np.where(there, different, 0)
        some = m.words > 0
        count = np.where(there, self.count[known], 0) if some else np.zeros(len(different))
        single = self.word_probability(np.where(there, self.before[known], 0) if some else np.zeros(len(different)))
        base = np.log10((count + 0.5) / (m.train_tokens + 0.5 * (m.words + 1)))[of]
        p = single[of]
        if some:
            before = np.roll(ids, 1)
            before[start] = self.numbering([END])[0]
            after = self.followers(known)
            left = (after[:, 1:] @ np.array(m.pair_discounts)) / np.maximum(after[:, 0], 1)
            at = np.searchsorted(different, before)
            at = np.minimum(at, len(different) - 1)
            seen = (before >= 0) & (different[at] == before)
            # The end token may stand before a text without being looked up among its words.
            extra = self.followers(np.maximum(before[start], 0))
            total, share = np.where(seen, after[at, 0], 0), np.where(seen, left[at], 0)
            total[start], share[start] = extra[:, 0], (extra[:, 1:] @ np.array(m.pair_discounts)) / np.maximum(extra[:, 0], 1)
            both = np.flatnonzero((total > 0) & (ids >= 0))
            key, inverse = np.unique(before[both].astype(np.uint64) << np.uint64(32) | ids[both].astype(np.uint64), return_inverse=True)
            first, second = (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
            firsts, where = np.unique(first, return_inverse=True)
            c = np.zeros(len(ids))
            c[both] = self.pair_counts(first, second, self.count[firsts][where])[inverse]
            d = np.array((0.0, *m.pair_discounts))
            with_context = np.maximum(c - d[np.minimum(c, 3).astype(np.int64)], 0) / np.maximum(total, 1) + share * p
            p = np.where(total > 0, with_context, p)
            if m.order == 3:
                p = self.with_two_words(ids, start, p)
        add = lambda x: np.add.reduceat(x, start) if len(start) else np.empty(0)
        return add((count > 0)[of].astype(np.int64)), add(base), add(np.log10(p))


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score, perplexity) of whole texts; log10 sums.

    One row per input row: repeated rows and null ids are scored like any
    other, null and empty texts are the end token alone. Other columns are left
    out, whatever their names; an empty table gives no rows.
    """
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        scorer = Scorer(model)
        for b in batches:
            out = []
            words: list[bytes] = []
            sizes: list[int] = []
            texts = b.column("_t").to_pylist()
            for k, t in enumerate(texts):
                own = tokens(t)
                words += own
                sizes.append(len(own))
                if len(words) > GATHER // 2 or k == len(texts) - 1:
                    out.append((np.array(sizes), *scorer(words, sizes)))
                    words, sizes = [], []
            if out:
                n, known, base, total = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [b.column("_id"), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base), pa.array(total),
                     pa.array(10.0 ** (-total / n))], names=["_id", "n_tokens", "n_known", "base_score", "score", "perplexity"])

    kind = source.schema["_id"].dataType.simpleString()
    return source.mapInArrow(run, f"_id {kind}, n_tokens long, n_known long, base_score double, score double, perplexity double") \
        .withColumnRenamed("_id", id_col)
