"""Scores by a log-bilinear language model.

The vector expected next is a linear function of the vectors of the two tokens
before; a token's energy is its product with the token's own vector, plus a
bias. The vocabulary is the end of a text, the most frequent words, and classes
of all other words by their last letters; a word of a class then has its share
of the class's counts. Counts are taken over all training texts. The model is
trained in numpy with noise-contrastive estimation. It starts as the unigram,
whose logarithms stay its biases, and learns what the two tokens before add. Each task
trains a model on every ``SHARD`` tokens of its texts, whatever it holds, and
all of these are averaged after each round.

As the expectation is linear, the energies of a context are the sum of one row
for each of its two tokens. The normalisers of all contexts are then one matrix
product, and each score is a proper log-probability.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.llm.chunks import sliced, unused
from freshet.session import shared_path

END = 0
CLASSES = 256
FREQUENT = 1791  # words with a vector of their own
LISTED = 200_000  # words whose counts are sent to all tasks
DIMENSIONS = 32
BATCH, NOISE, RATE = 2048, 32, 0.05
NOISE_BLOCK = 256  # targets that share their noise words
SHARD = 200_000  # tokens that one model is trained on before it is averaged
FAN = 32  # models that a task adds up
ROUNDS = 2
CODED_WORDS = 400_000  # words that a worker remembers
COUNTED_WORDS = 300_000  # words that a task counts before it hands them on
SEED = 5
END_KEY = np.uint64(xxhash.xxh3_64_intdigest(b"\n")).astype(np.int64)  # no word has white space
_TABLES: dict = {}


def key(word: bytes) -> int:
    """A word's 64-bit hash as a signed number; it stands for the word in all counts."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(word)).astype(np.int64))


def class_of(word: bytes) -> int:
    return zlib.crc32(word.rstrip(b".,;:!?")[-3:]) % CLASSES


def words_of(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case."""
    return text.lower().split() if text else []


def count_words(texts: DataFrame) -> DataFrame:
    """``key``, ``class`` and ``n`` of all words of the ``text`` column, and of the ends (class -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen[b"\n"] += 1
                seen.update(words_of(text.as_py()))
                if len(seen) > COUNTED_WORDS:
                    yield counted(seen)
                    seen = Counter()
        if seen:
            yield counted(seen)

    found = texts.mapInArrow(run, "key long, class int, n long")
    return found.groupBy("key").agg(F.max("class").alias("class"), F.sum("n").alias("n"))


def counted(seen: Counter) -> pa.RecordBatch:
    keys = pa.array(np.fromiter(map(xxhash.xxh3_64_intdigest, seen), np.uint64, len(seen)).view(np.int64))
    classes = pa.array([-1 if w == b"\n" else class_of(w) for w in seen], pa.int32())
    return pa.RecordBatch.from_arrays([keys, classes, pa.array(list(seen.values()), pa.int64())], names=["key", "class", "n"])


@dataclass
class Vocabulary:
    """What all tasks know of the counts; its size does not follow the corpus."""

    keys: np.ndarray  # of the listed words, the end first, then by falling count
    counts: np.ndarray
    classes: np.ndarray
    total: int
    distinct: int
    mass: np.ndarray  # by class, the smoothed counts of its words, and of one unknown word

    @property
    def size(self) -> int:
        return 1 + FREQUENT + CLASSES

    @property
    def divisor(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)

    def ids(self) -> np.ndarray:
        """The model's id of each listed word: its own, or its class's."""
        place = np.arange(len(self.keys))
        return np.where(place <= FREQUENT, place, 1 + FREQUENT + self.classes)

    def unigram(self) -> np.ndarray:
        share = np.full(self.size, 0.5)
        own = min(len(self.counts), FREQUENT + 1)
        share[:own] += self.counts[:own]
        share[1 + FREQUENT :] = self.mass
        return share / share.sum()


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Reads the listed words and the sums over all words from written counts."""
    words = counts.filter("class >= 0")
    sums = counts.agg(F.sum("n").alias("total"), F.count("*").alias("distinct")).first()
    top = words.orderBy(F.desc("n"), "key").limit(LISTED).toArrow()
    end = counts.filter("class < 0").select("n").first()
    keys = np.r_[END_KEY, np.asarray(top["key"])].astype(np.int64)
    found = np.r_[end["n"] if end else 0, np.asarray(top["n"])].astype(np.int64)
    classes = np.r_[0, np.asarray(top["class"])].astype(np.int64)
    mass = np.full(CLASSES, 0.5)
    for row in words.groupBy("class").agg(F.sum(F.col("n") + 0.5).alias("mass")).collect():
        mass[row["class"]] += row["mass"]
    own = slice(1, FREQUENT + 1)
    np.subtract.at(mass, classes[own], found[own] + 0.5)
    return Vocabulary(keys, found, classes, int(sums["total"] or 0), int(sums["distinct"]), np.maximum(mass, 0.5))


class Coder(dict):
    """Numbers of words: their place in the list, or minus one and less for a class."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.listed = {int(k): i for i, k in enumerate(vocabulary.keys)}

    def __missing__(self, word: bytes) -> int:
        number = self.listed.get(key(word))
        if number is None:
            number = -1 - class_of(word)
        if len(self) < CODED_WORDS:
            self[word] = number
        return number

    def encode(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def coder_of(vocabulary: Vocabulary) -> Coder:
    """The coder of a vocabulary, made once per worker, so its tasks share the words it remembers."""
    if _TABLES.get("vocabulary") is not vocabulary:
        _TABLES.update(vocabulary=vocabulary, coder=Coder(vocabulary))
    return _TABLES["coder"]


def model_ids(numbers: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return np.where(numbers >= 0, ids[np.maximum(numbers, 0)], FREQUENT - numbers)  # -1 - class, behind the frequent words


@dataclass
class Model:
    context: np.ndarray  # vectors of tokens as context
    target: np.ndarray  # and as what comes next
    near: np.ndarray  # linear maps of the token before and of the one before that
    far: np.ndarray
    bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.target, self.near, self.far, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()]).astype(np.float64)

    @staticmethod
    def of(flat: np.ndarray, size: int) -> Model:
        d, at, parts = DIMENSIONS, 0, []
        for shape in ((size, d), (size, d), (d, d), (d, d), (size,)):
            n = int(np.prod(shape))
            parts.append(flat[at : at + n].reshape(shape).astype(np.float32))
            at += n
        return Model(*parts)


def first_model(unigram: np.ndarray) -> Model:
    draw = np.random.default_rng(SEED)
    size, d = len(unigram), DIMENSIONS
    near, far = np.eye(d), 0.5 * np.eye(d)
    flat = [draw.standard_normal((size, d)) * 0.1, draw.standard_normal((size, d)) * 0.1, near, far]
    return Model(*(p.astype(np.float32) for p in flat), np.log(unigram).astype(np.float32))


class Trainer:
    """Noise-contrastive estimation with a step size for each parameter."""

    def __init__(self, model: Model, unigram: np.ndarray, seed: int):
        self.model = Model(*(p.copy() for p in model.parts()))
        self.draw = np.random.default_rng(seed)
        self.reach = np.cumsum(unigram)
        self.noise = np.log(NOISE * unigram).astype(np.float32)  # expected log count among the noise
        self.squares = [np.full_like(p, 1e-6) for p in self.model.parts()[:-1]]
        self.seen = 0

    def step(self, far: np.ndarray, near: np.ndarray, word: np.ndarray) -> None:
        m, size = self.model, len(self.reach)
        blocks = np.array_split(np.arange(len(word)), max(1, round(len(word) / NOISE_BLOCK)))
        drawn = np.searchsorted(self.reach, self.draw.random((len(blocks), NOISE)))
        noise = np.minimum(drawn, size - 1)
        r1, r2 = np.take(m.context, near, axis=0), np.take(m.context, far, axis=0)
        expected = r1 @ m.near + r2 @ m.far
        true = np.take(m.target, word, axis=0)
        pull = 1 - sigmoid(np.einsum("ij,ij->i", expected, true) + m.bias[word] - self.noise[word])
        back = pull[:, None] * true
        moved = [pull[:, None] * expected]
        for rows, other in zip(blocks, noise, strict=True):
            rows = slice(rows[0], rows[-1] + 1)
            vectors = m.target[other]
            push = sigmoid(expected[rows] @ vectors.T + (m.bias[other] - self.noise[other]))
            back[rows] -= push @ vectors
            moved.append(-(push.T @ expected[rows]))
        # A row without a gradient stays as it is, so only the others are touched.
        for n, (places, rows) in enumerate(
            [
                summed(np.r_[near, far], np.concatenate([back @ m.near.T, back @ m.far.T])),
                summed(np.r_[word, noise.ravel()], np.concatenate(moved)),
                (slice(None), r1.T @ back),
                (slice(None), r2.T @ back),
            ]
        ):  # the biases stay
            part, square, grad = m.parts()[n], self.squares[n], rows
            grad /= len(word)
            squares = square[places] + grad * grad
            square[places] = squares
            grad *= RATE
            grad /= np.sqrt(squares)
            part[places] += grad
        self.seen += len(word)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def summed(places: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct places, and their rows added up."""
    order = np.argsort(places.astype(np.uint16), kind="stable")  # ids of the model are small
    places = places[order]
    begins = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
    return places[begins], np.add.reduceat(np.take(rows, order, axis=0), begins, axis=0)


def stream(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two ends, the tokens and the end of each text in one row, and which of them are targets."""
    whole = np.full(sum(map(len, codes)) + 3 * len(codes), END, np.int64)
    target = np.ones(len(whole), bool)
    at = 0
    for code in codes:
        target[at : at + 2] = False
        whole[at + 2 : at + 2 + len(code)] = code
        at += len(code) + 3
    return whole, target


def train(texts: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS) -> Model:
    """The model of all texts. Round r takes those with ``part`` r; every shard starts
    from the average of the round before, and averages weigh by tokens. Sums of
    parameters go through as many levels of tasks as let each add up ``FAN`` of
    them. Tasks of less than a shard train on what they have, so the model depends
    on the partitioning only where tasks are that small."""
    context = texts.sparkSession.sparkContext
    unigram = vocab.unigram()
    model = first_model(unigram)
    for number in range(rounds):
        shared = context.broadcast((model, vocab, unigram))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, number=number) -> Iterator[pa.RecordBatch]:
            start, vocab, unigram = shared.value
            coder, ids, trainer = coder_of(vocab), vocab.ids(), Trainer(start, unigram, SEED + number)
            tokens, sums, shard = 0, np.zeros(len(start.flat())), 0
            for batch in batches:
                codes = (model_ids(coder.encode(words_of(t.as_py())), ids) for t in batch.column(0))
                for part in sliced(codes, lambda c: len(c) + 1, 4 * BATCH):
                    whole, target = stream(part)
                    at = trainer.draw.permutation(np.flatnonzero(target))
                    for piece in np.array_split(at, max(1, round(len(at) / BATCH))):
                        trainer.step(whole[piece - 2], whole[piece - 1], whole[piece])
                        if trainer.seen >= SHARD:
                            tokens, sums, shard = tokens + trainer.seen, sums + trainer.model.flat() * trainer.seen, shard + 1
                            trainer = Trainer(start, unigram, SEED + number + shard * ROUNDS)
            if tokens + trainer.seen:
                yield weighted(tokens + trainer.seen, sums + trainer.model.flat() * trainer.seen)

        parts = texts.filter(F.col("part") == number).select("text").mapInArrow(run, "tokens long, sums binary")
        tasks, level = parts.rdd.getNumPartitions(), parts
        while tasks > 1:
            tasks = -(-tasks // FAN)
            level = level.repartition(tasks).mapInArrow(added, parts.schema)
        total = level.first()
        if total is not None:
            model = Model.of(np.frombuffer(total["sums"]) / total["tokens"], vocab.size)
    return model


def weighted(tokens: int, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([tokens], pa.int64()), pa.array([sums.tobytes()], pa.binary())], names=["tokens", "sums"])


def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokens, sums = 0, None
    for batch in batches:
        for n, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            part = np.frombuffer(part.as_py())
            tokens, sums = tokens + n, part.copy() if sums is None else sums + part
    if sums is not None:
        yield weighted(tokens, sums)


class Tables:
    """Energies and normalisers of all contexts, in natural logarithms."""

    def __init__(self, model: Model):
        self.near = (model.context @ model.near) @ model.target.T
        self.far = (model.context @ model.far) @ model.target.T
        self.bias = model.bias
        tops = [t.max(1, keepdims=True) for t in (self.near, self.far)]
        product = (np.exp(self.near - tops[0]) * np.exp(self.bias)) @ np.exp(self.far - tops[1]).T
        self.normaliser = np.log(product) + tops[0] + tops[1].T

    def log_probability(self, far: np.ndarray, near: np.ndarray, word: np.ndarray) -> np.ndarray:
        return self.near[near, word] + self.far[far, word] + self.bias[word] - self.normaliser[near, far]


def prepared(model: Model, vocab: Vocabulary) -> tuple[Tables, Coder]:
    """The tables of a model, made once per worker."""
    if _TABLES.get("model") is not model:
        _TABLES.update(model=model, tables=Tables(model))
    return _TABLES["tables"], coder_of(vocab)


def score(docs: DataFrame, counts: DataFrame, vocab: Vocabulary, model: Model, text: str = "text") -> DataFrame:
    """All rows with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    Tasks score what the listed words tell; the counts of all other words are
    joined on, one row per text and word. No unlisted word is frequent, so no
    key of that join is hot.
    """
    spark = docs.sparkSession
    names = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    kept = docs.drop(*names)
    body = unused(docs.columns, "_body")
    rows = docs.withColumn(body, F.col(text).cast("binary")).drop(*names)
    shared = spark.sparkContext.broadcast((model, vocab))
    own = kept.columns
    made = ("_row", "_tokens", "_known", "_base", "_score", "_keys", "_times")
    row_, tokens_, known_, base_, score_, keys_, times_ = (unused(docs.columns, n) for n in made)
    schema = T.StructType([*kept.schema.fields])
    for name in (row_, tokens_, known_):
        schema = schema.add(name, T.LongType())
    for name in (base_, score_):
        schema = schema.add(name, T.DoubleType())
    schema = schema.add(keys_, T.ArrayType(T.LongType())).add(times_, T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        model, vocab = shared.value
        tables, coder = prepared(model, vocab)
        ids = vocab.ids()
        log_counts = np.log10(vocab.counts + 0.5)
        of_class = np.r_[np.zeros(1 + FREQUENT), np.log10(vocab.mass)]
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            words = (words_of(t.as_py()) for t in batch.column(batch.num_columns - 1))
            at = 0
            for part in sliced(words, lambda w: len(w) + 1, 200_000):
                numbers = [coder.encode(w) for w in part]
                whole, target = stream([model_ids(n, ids) for n in numbers])
                place = np.flatnonzero(target)
                likely = tables.log_probability(whole[place - 2], whole[place - 1], whole[place]) / np.log(10)
                likely = likely - of_class[whole[place]]
                flat = np.concatenate([np.r_[n, 0] for n in numbers])  # 0 is the end's place in the list
                listed = flat >= 0
                from_list = np.where(listed, log_counts[np.maximum(flat, 0)], 0.0)
                known = listed & (vocab.counts[np.maximum(flat, 0)] > 0)
                frequent = whole[place] <= FREQUENT
                likely = likely + np.where(listed & ~frequent, from_list, 0.0)  # the word's share of its class
                begins = np.r_[0, np.cumsum([len(n) + 1 for n in numbers])[:-1]]
                keys, times = [], []
                for w, n in zip(part, numbers, strict=True):
                    rare = Counter([w[i] for i in np.flatnonzero(n < 0)])
                    keys.append(np.fromiter(map(xxhash.xxh3_64_intdigest, rare), np.uint64, len(rare)).view(np.int64))
                    times.append(np.fromiter(rare.values(), np.int32, len(rare)))
                offsets = pa.array(np.r_[0, np.cumsum([len(k) for k in keys])].astype(np.int32))
                n = len(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.slice(at, n) for c in batch.columns[:-1]),
                        pa.array(np.arange(row, row + n)),
                        pa.array(np.array([len(c) + 1 for c in numbers], np.int64)),
                        pa.array(np.add.reduceat(known.astype(np.int64), begins)),
                        pa.array(np.add.reduceat(from_list, begins)),
                        pa.array(np.add.reduceat(likely, begins)),
                        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(keys))),
                        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(times))),
                    ],
                    names=schema.names,
                )
                row, at = row + n, at + n

    path = shared_path(spark, "scored")
    rows.mapInArrow(run, schema).write.parquet(path)
    scored = spark.read.parquet(path)
    pairs = F.arrays_zip(F.col(keys_).alias("key"), F.col(times_).alias("times"))
    rare = scored.select(F.col(row_).alias("row"), F.inline(pairs))
    told = rare.join(counts.filter("class >= 0").select("key", "n"), "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    sums = told.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more"),
        F.sum(F.col("times") * F.log10(F.col("n") + 0.5)).alias("logs"),
    )
    both = scored.join(sums, scored[row_] == sums["row"], "left")
    logs = F.coalesce(sums["logs"], F.lit(0.0))
    return both.select(
        *(scored[c] for c in own),
        scored[tokens_].alias("n_tokens"),
        (scored[known_] + F.coalesce(sums["more"], F.lit(0))).cast("long").alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (scored[base_] + logs - scored[tokens_] * float(np.log10(vocab.divisor))).alias("base_score"),
        (scored[score_] + logs).alias("score"),
    )


def score_corpus(docs: DataFrame, training: DataFrame, text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Counts and trains on ``training`` and scores ``docs``, both with whole texts.

    Tokens are words between ASCII white space, A-Z lower-cased, then one end.
    Adds ``n_tokens``, ``n_known`` (tokens met in training), ``train_tokens``,
    ``base_score`` (smoothed unigram) and ``score``, both as the log10 of the
    text's probability; columns of these names are replaced. A null or empty
    text is one end. Repeated rows count and are scored each on their own. How the
    training table is partitioned changes a score little (see ``train``). An
    empty training table leaves the smoothing alone; an empty ``docs`` no rows.
    Words are told apart by 64-bit hashes, and a list of ``LISTED`` words, 256
    classes and one matrix of parameters are all that comes to the driver.
    """
    spark = docs.sparkSession
    texts = training.select(F.col(text).cast("binary").alias("text"))
    path = shared_path(spark, "counts")
    count_words(texts).write.parquet(path)
    counts = spark.read.parquet(path)
    vocab = vocabulary(counts)
    halves = texts.withColumn("part", F.pmod(F.xxhash64("text"), F.lit(rounds)).cast("int"))
    return score(docs, counts, vocab, train(halves, vocab, rounds), text)
