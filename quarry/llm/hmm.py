"""Language-model scoring by a hidden Markov model.

Words are white-space runs with A-Z lowered; a text is its words and one end
token.  The model walks through ``states`` latent states; in each it emits a
word.  Every word of the training texts has an emission row of its own; all
unseen words together have one slot.  The likelihood of a text is exact, by
the scaled forward recursion.

Training is Baum-Welch over all training documents: each pass runs the
forward-backward recursion in every task, sums expected starts, transitions
and emissions there, and adds the tasks' sums in a shuffle.  Rows are kept in
two places.  The most frequent words (a fixed bound in number and bytes) and
the end token have theirs in the model that the driver holds and every task
gets.  All other words share ``TAIL_SYMBOLS`` tied rows by hash until the last
pass, which unties them: it adds up expected counts by word and state, however
many words there are, and writes them as a table.  Scoring joins that table
back by word.  A rare word's split over the states is drawn to the split of
all rare words by ``RARE_PRIOR`` occurrences, and add-one smoothing leaves the
slot of the unseen; the rows of a state, slot included, sum to one.

The base score is the add-one unigram: the sum over tokens of
``log10((c + 1) / (N + V + 1))``.

Documents are encoded in chunks of about ``CHUNK_BYTES`` of text, each with the list of
its distinct rare words, so what crosses the shuffles is distinct words of
chunks, not tokens.  Expected counts cross them in whole 1/``FRACTION`` of an
occurrence: most are zero, and their sums do not depend on the order.  Encoded chunks, counts and learned rows are written to the
shared folder and reread.

Defined results: a null or empty text is its end token; a null id is hashed as
empty text; repeated rows are scored each on their own; an empty table gives
no rows, and without training documents all counts are zero; a very long text
is a chunk of its own and held by one task (about 400 bytes a token); other
columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Collection, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import arrow_schema, batches_of, chunk_ends, ddl, return_memory, utf8, words_of, write_shared

STATES = 8
PASSES = 5
OWN_SYMBOLS = 49_152          # words whose rows are in the model, at most
OWN_BYTES = 256               # length of such a word, at most
TAIL_SYMBOLS = 4096           # rows that all other words share before the last pass
PRIOR = 200.0                 # pseudo-tokens of the unigram in each state's emissions
RARE_PRIOR = 2.0              # occurrences at the mean split over states that a rare word's split is drawn by
STICKY = 0.9                  # first guess of the chance to stay in a state
HELD_OUT = (7, 2)             # divisor and remainder that mark held-out documents
PARTIAL_WORDS = 200_000       # distinct words counted in a task before they are passed on
COUNT_BYTES = 2 << 20         # text whose words are counted together
GROUP_TOKENS = 250_000        # tokens of documents that are run together, twice as many in the tied passes
MOVE_BLOCK = 1 << 15          # steps whose transitions are summed together
SYMBOL_BLOCK = 1024
CHUNK_BYTES = 8 << 20         # text that is encoded together
FRACTION = 256                # the last pass adds expected counts in whole parts of an occurrence
ROW_BLOCK = 1 << 15           # rows of expected counts passed on together
END = b""                     # the end token among the counted words
WORD_ROW, OWN_ROW, EDGE_ROW = 0, 1, 2     # kinds of sums of the last pass
#: Parquet looks at sizes after 100 rows, if not told otherwise: pages and row groups, and what
#: writers and readers hold of them off the heap, would be as large as all chunks of a task.
LARGE_ROWS = {"compression": "zstd", "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1", "parquet.block.size": str(1 << 22)}


@dataclass(frozen=True)
class Symbols:
    """Words with rows in the model, and the counts of all."""

    words: list[bytes]        # by falling frequency; their symbols are 1, 2, ..., the end token's is 0
    counts: np.ndarray        # of ``words``
    end_count: int
    tail_tokens: np.ndarray   # training tokens and distinct words of the others by shared symbol
    tail_words: np.ndarray
    tokens: int               # all training tokens, distinct ones
    distinct: int

    @property
    def own(self) -> int:
        return len(self.words)

    @property
    def head(self) -> int:
        return 1 + self.own

    @property
    def rare_tokens(self) -> float:
        return float(self.tail_tokens.sum())

    @property
    def rare_slots(self) -> float:
        """Add-one total of the rare words, the slot of the unseen included."""
        return float(self.tail_tokens.sum() + self.tail_words.sum()) + 1.0


@dataclass(frozen=True)
class Model:
    start: np.ndarray         # (states)
    move: np.ndarray          # (states, states)
    emit: np.ndarray          # (symbols, states)


@dataclass(frozen=True)
class Rare:
    """Turns expected counts of rare words into their emission rows."""

    mass: np.ndarray          # (states) chance of any rare or unseen word
    split: np.ndarray         # (states) mean split of rare words over states
    sums: np.ndarray          # (states) of all smoothed counts
    tokens: float
    slots: float

    def rows(self, counts: np.ndarray, expected: np.ndarray) -> np.ndarray:
        """``(words, states)``; a word that was not seen has count 0."""
        n = counts[:, None]
        smoothed = n * (expected + RARE_PRIOR * self.split) / (n + RARE_PRIOR)
        return self.mass * (smoothed * (self.tokens / np.maximum(self.sums, 1e-300)) + 1.0) / self.slots


# ------------------------------------------------------------------ counting


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(ddl("word:binary n:long"))
    held: list[pa.Table] = []

    def summed() -> pa.Table:
        return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

    for batch in batches:
        texts, done = batch.column(0), 0
        for end in chunk_ends(texts, COUNT_BYTES):
            here = texts.slice(done, end - done)
            counts = words_of(here)[1].value_counts()
            held.append(pa.table({"word": pc.cast(counts.field(0), pa.binary()), "n": counts.field(1)}))
            held.append(pa.table({"word": pa.array([END], pa.binary()), "n": pa.array([len(here)], pa.int64())}))
            done = end
            if sum(map(len, held)) > 2 * PARTIAL_WORDS:
                held = [summed()]
                if len(held[0]) > PARTIAL_WORDS:
                    yield from held[0].cast(schema).to_batches()
                    held = []
    if held:
        yield from summed().cast(schema).to_batches()


def count_words(training: DataFrame) -> DataFrame:
    """``(word, c)`` over all training texts, the end token as an empty word."""
    partial = training.select("text").mapInArrow(_count, ddl("word:binary n:long"))
    return write_shared(partial.groupBy("word").agg(F.sum("n").alias("c")), "words")


def tail_symbols(words: Collection[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), dtype=np.int64, count=len(words)) % TAIL_SYMBOLS


def choose_symbols(words: DataFrame) -> Symbols:
    """Cut the words by frequency; the cut falls between steps of a logarithmic scale, below the bound."""
    step = F.floor(F.log2(F.col("c")) * 8).cast("int")
    short = F.length("word") <= OWN_BYTES
    real = words.where(F.length("word") > 0).withColumn("step", step)
    steps = real.where(short).groupBy("step").agg(F.count(F.lit(1)).alias("n")).collect()
    totals = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("distinct")).first()
    end = words.where(F.length("word") == 0).select("c").first()
    held, cut = 0, 64 * 8
    for r in sorted(steps, key=lambda r: -r["step"]):
        held += r["n"]
        if held <= OWN_SYMBOLS:
            cut = r["step"]
    frequent = short & (F.col("step") >= cut)
    own = sorted(((bytes(r["word"]), r["c"]) for r in real.where(frequent).select("word", "c").collect()), key=lambda r: (-r[1], r[0]))
    tail = (real.where(~frequent).groupBy(F.pmod(F.crc32("word"), F.lit(TAIL_SYMBOLS)).cast("int").alias("s"))
            .agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect())
    tail_tokens, tail_words = np.zeros(TAIL_SYMBOLS), np.zeros(TAIL_SYMBOLS)
    for r in tail:
        tail_tokens[r["s"]], tail_words[r["s"]] = r["c"], r["n"]
    return Symbols([w for w, _ in own], np.array([c for _, c in own], dtype=np.int64),
                   end["c"] if end else 0, tail_tokens, tail_words, totals["tokens"], totals["distinct"])


# ------------------------------------------------------------------ encoding

ENCODED = ddl("held_out:boolean doc_ids:longs lengths:binary ids:binary rare:binary words:binaries")


def encode(docs: DataFrame, symbols: Symbols) -> DataFrame:
    """Chunks of documents of one kind (training, held out): a row each.

    ``ids`` are the symbols of all tokens, ``words`` the distinct rare words of
    the chunk, and ``rare`` their places for the tokens with a shared symbol.
    """
    words, head = symbols.words, symbols.head
    schema = arrow_schema(ENCODED)

    def chunk(texts: pa.Array, at: dict[bytes, int]) -> dict:
        lengths, tokens = words_of(texts)
        coded = tokens.dictionary_encode()               # distinct words in the order of their first place
        distinct, place = coded.dictionary.to_numpy(zero_copy_only=False), coded.indices.to_numpy()
        symbol = np.fromiter(map(at.get, distinct, repeat(-1)), dtype=np.int64, count=len(distinct))
        seldom = np.flatnonzero(symbol < 0)
        rare_words = coded.dictionary.take(pa.array(seldom))
        symbol[seldom] = head + tail_symbols(distinct[seldom])
        rare_place = np.full(len(distinct), -1, dtype=np.int64)
        rare_place[seldom] = np.arange(len(seldom))
        rare = rare_place[place]
        ids = np.zeros(len(place) + len(texts), dtype="<u2")      # the end token's stay 0
        ids[np.arange(len(place)) + np.repeat(np.arange(len(texts)), lengths)] = symbol[place]
        return {"lengths": (lengths + 1).astype("<u4").tobytes(), "ids": ids.tobytes(), "rare": rare[rare >= 0].astype("<u4").tobytes(),
                "words": rare_words}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = {w: k + 1 for k, w in enumerate(words)}
        for batch in batches:
            done = 0
            for end in chunk_ends(batch.column(1), CHUNK_BYTES):
                part, done = batch.slice(done, end - done), end
                for held in (False, True):
                    of_kind = part.filter(pc.equal(part.column(2), held))
                    if not of_kind.num_rows:
                        continue
                    row = chunk(of_kind.column(1), at)
                    listed = {"doc_ids": of_kind.column(0), "words": row.pop("words").cast(pa.binary())}
                    columns = {name: [value] for name, value in (("held_out", held), *row.items())}
                    for name, values in listed.items():
                        columns[name] = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values).cast(schema.field(name).type)
                    yield from batches_of(schema, columns)
        return_memory()

    coded = docs.select("doc_id", "text", "held_out").mapInArrow(run, ENCODED)
    return write_shared(coded.withColumn("chunk", F.monotonically_increasing_id()), "encoded", **LARGE_ROWS)


def documents_of(ids: np.ndarray, lengths: bytes) -> list[np.ndarray]:
    return np.split(ids, np.cumsum(np.frombuffer(lengths, dtype="<u4"))[:-1])


def own_rows(ids: bytes, rare: bytes, head: int) -> np.ndarray:
    """Symbols of a chunk in which every rare word has its own, behind those of the model."""
    symbols = np.frombuffer(ids, dtype="<u2").astype(np.int64)
    symbols[symbols >= head] = head + np.frombuffer(rare, dtype="<u4").astype(np.int64)
    return symbols


# ------------------------------------------------------------------ recursion


class Group:
    """Documents run together, longest first: the tokens of one time step stand side by side."""

    def __init__(self, docs: list[np.ndarray]):
        lengths = np.array([len(d) for d in docs], dtype=np.int64)
        steps = int(lengths[0])
        self.active = np.searchsorted(-lengths, -np.arange(1, steps + 1), side="right")   # documents longer than t
        self.at = np.append(0, np.cumsum(self.active))
        time = np.concatenate([np.arange(n) for n in lengths])
        self.place = self.at[time] + np.repeat(np.arange(len(docs)), lengths)
        self.symbols = np.empty(int(self.at[-1]), dtype=np.int64)
        self.symbols[self.place] = np.concatenate(docs)
        self.lengths = lengths

    def forward(self, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scaled forward values, the scales, and the emissions, all by place."""
        emissions = model.emit[self.symbols]
        alpha = np.empty_like(emissions)
        scale = np.empty(len(emissions), dtype=emissions.dtype)
        prior = model.start[None, :]
        for t, n in enumerate(self.active.tolist()):
            a = self.at[t]
            here = (prior if t == 0 else alpha[a - self.active[t - 1]:a - self.active[t - 1] + n] @ model.move) * emissions[a:a + n]
            total = here.sum(axis=1)
            np.divide(here, total[:, None], out=alpha[a:a + n])
            scale[a:a + n] = total
        return alpha, scale, emissions

    def log_likelihoods(self, scale: np.ndarray) -> np.ndarray:
        logs = np.log10(scale, dtype=np.float64)[self.place]
        return np.add.reduceat(logs, np.append(0, np.cumsum(self.lengths)[:-1]))

    def expected(self, model: Model, emitted: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Expected starts and transitions; adds expected emissions to ``emitted`` (states, symbols)."""
        alpha, scale, emissions = self.forward(model)
        weighted = np.divide(emissions, scale[:, None], out=emissions)      # becomes emission * beta / scale
        beta = np.ones_like(alpha)
        back = model.move.T
        for t in range(len(self.active) - 2, -1, -1):
            a, b, n = self.at[t], self.at[t + 1], self.active[t + 1]
            beta[a:a + n] = weighted[b:b + n] @ back
            weighted[a:a + n] *= beta[a:a + n]
        first, moves = self.active[0], np.zeros_like(model.move)
        before = np.arange(first, len(alpha)) - np.repeat(self.active[:-1], self.active[1:])
        for a in range(0, len(before), MOVE_BLOCK):
            moves += alpha[before[a:a + MOVE_BLOCK]].T @ weighted[first + a:first + a + MOVE_BLOCK]
        moves *= model.move
        np.multiply(alpha, beta, out=beta)
        del alpha, emissions, weighted
        gamma = np.ascontiguousarray(beta.T)
        del beta
        for s, of_state in enumerate(gamma):
            emitted[s] += np.bincount(self.symbols, weights=of_state, minlength=emitted.shape[1])
        return gamma[:, :first].sum(axis=1), moves, float(np.log10(scale, dtype=np.float64).sum())


def grouped(docs: list[np.ndarray], tokens: int = GROUP_TOKENS) -> Iterator[tuple[np.ndarray, Group]]:
    """Documents of similar length in groups of about ``tokens``, with their positions."""
    order = np.argsort([-len(d) for d in docs], kind="stable")
    held, size = [], 0
    for k in order.tolist():
        held.append(k)
        size += len(docs[k])
        if size >= tokens:
            yield np.array(held), Group([docs[j] for j in held])
            held, size = [], 0
    if held:
        yield np.array(held), Group([docs[j] for j in held])


def first_model(symbols: Symbols, states: int, seed: int = 11) -> tuple[Model, np.ndarray]:
    """The unigram disturbed differently in every state, and the unigram."""
    shared = symbols.tail_tokens + symbols.tail_words + 1.0 / TAIL_SYMBOLS
    counts = np.concatenate([[symbols.end_count + 1.0], symbols.counts + 1.0, shared])
    background = counts / counts.sum()
    noise = np.random.default_rng(seed).normal(size=(len(counts), states))
    noise[0] = 0
    emit = background[:, None] * np.exp(noise)
    emit /= emit.sum(axis=0)
    move = np.full((states, states), (1 - STICKY) / max(1, states - 1))
    np.fill_diagonal(move, STICKY if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), move, emit), background


def single(model: Model) -> Model:
    """In single precision: the passes need no more and read half the bytes."""
    return Model(*(np.ascontiguousarray(x, dtype=np.float32) for x in (model.start, model.move, model.emit)))


SUMS = ddl("block:int sums:binary log10:double")


def _tied_pass(model: Model):
    """A task's expected counts in blocks of symbols; block -1 holds starts and transitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(SUMS)
        states, total = len(model.start), 0.0
        emitted = np.zeros((states, len(model.emit)))
        starts, moves = np.zeros(states), np.zeros((states, states))
        for batch in batches:
            docs = [d for ids, lengths in zip(batch.column(0), batch.column(1))
                    for d in documents_of(np.frombuffer(ids.as_buffer(), dtype="<u2"), lengths.as_buffer())]
            for _, group in grouped(docs, 2 * GROUP_TOKENS):
                s, m, log10 = group.expected(model, emitted)
                starts, moves, total = starts + s, moves + m, total + log10
        return_memory()
        out = [(-1, np.vstack([starts, moves]).astype("<f8").tobytes(), total)]
        for b in range(0, emitted.shape[1], SYMBOL_BLOCK):
            out.append((b // SYMBOL_BLOCK, emitted[:, b:b + SYMBOL_BLOCK].astype("<f4").tobytes(), 0.0))
        yield from batches_of(schema, dict(zip(("block", "sums", "log10"), map(list, zip(*out)))))

    return run


def _add(table: pa.Table) -> pa.Table:
    block = table["block"][0].as_py()
    total = sum(np.frombuffer(x, dtype="<f8" if block < 0 else "<f4").astype("<f8") for x in table["sums"].to_pylist())
    return pa.table({"block": pa.array([block], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary()),
                     "log10": pa.array([sum(table["log10"].to_pylist())], pa.float64())})


def sums_type(states: int) -> T.StructType:
    return ddl("kind:int at:int word:binary n:long log10:double " + " ".join(f"e{s}:long" for s in range(states)))


def _untied_pass(model: Model, head: int):
    """Expected counts of every word: rare ones by chunk, the model's own and the edges once a task."""
    states = len(model.start)
    schema = arrow_schema(sums_type(states))

    def rows(kind: int, words: pa.Array | None, n: np.ndarray, sums: np.ndarray, log10: float = 0.0) -> Iterator[pa.RecordBatch]:
        size = len(sums)
        at = np.arange(size) if words is None else np.zeros(size)
        logs = np.zeros(size)
        logs[:1] = log10
        columns = {"kind": pa.array(np.full(size, kind, dtype=np.int32)), "at": pa.array(at.astype(np.int32)),
                   "word": pa.array([END] * size, pa.binary()) if words is None else words, "n": pa.array(n, pa.int64()),
                   "log10": pa.array(logs)}
        columns |= {f"e{s}": pa.array(np.rint(sums[:, s] * FRACTION).astype(np.int64)) for s in range(states)}
        yield from batches_of(schema, columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emitted, total = np.zeros((states, head)), 0.0
        starts, moves = np.zeros(states), np.zeros((states, states))
        for batch in batches:
            for k in range(batch.num_rows):
                ids, lengths, rare = (batch.column(c)[k].as_buffer() for c in range(3))
                words, symbols = batch.column(3)[k].values, own_rows(ids, rare, head)
                tied = np.frombuffer(ids, dtype="<u2")
                shared = np.empty(len(words), dtype=np.int64)
                shared[np.frombuffer(rare, dtype="<u4")] = tied[tied >= head]
                here = Model(model.start, model.move, np.concatenate([model.emit[:head], model.emit[shared]]))
                sums = np.zeros((states, head + len(words)))
                for _, group in grouped(documents_of(symbols, lengths)):
                    s, m, log10 = group.expected(here, sums)
                    starts, moves, total = starts + s, moves + m, total + log10
                emitted += sums[:, :head]
                if len(words):
                    seen = np.bincount(symbols, minlength=head + len(words))[head:]
                    for a in range(0, len(words), ROW_BLOCK):
                        b = min(a + ROW_BLOCK, len(words))
                        yield from rows(WORD_ROW, words[a:b], seen[a:b], sums[:, head + a:head + b].T)
                return_memory()
        yield from rows(OWN_ROW, None, np.zeros(head, dtype=np.int64), emitted.T)
        yield from rows(EDGE_ROW, None, np.zeros(states + 1, dtype=np.int64), np.vstack([starts, moves]), total)

    return run


def _next(edges: np.ndarray, emitted: np.ndarray, background: np.ndarray) -> Model:
    """The model of expected counts: starts and transitions as rows of ``edges``, emissions by symbol."""
    starts, moves = edges[0] + 1.0, edges[1:] + 1.0
    emit = emitted + PRIOR * background[:, None]
    return Model(starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def train(encoded: DataFrame, symbols: Symbols, states: int = STATES, passes: int = PASSES) -> tuple[Model, Rare, DataFrame, list[float]]:
    """Baum-Welch over the training documents.

    Returns the model (rows of the end token and the frequent words), what the
    rare words' rows are made with, the table of their expected counts
    (``word, n, e0, e1, ...``, in ``1 / FRACTION``) and the log10 likelihood before each pass.
    """
    model, background = first_model(symbols, states)
    training = encoded.where("NOT held_out")
    tasks = 4 * encoded.sparkSession.sparkContext.defaultParallelism
    head, history = symbols.head, []
    for _ in range(passes - 1):
        sums = training.select("ids", "lengths").coalesce(tasks).mapInArrow(_tied_pass(single(model)), SUMS)
        rows = {r["block"]: r for r in sums.groupBy("block").applyInArrow(_add, SUMS).collect()}
        if -1 not in rows:
            break
        edges = np.frombuffer(rows[-1]["sums"], dtype="<f8").reshape(states + 1, states)
        history.append(rows[-1]["log10"])
        emitted = np.concatenate([np.frombuffer(rows[b]["sums"], dtype="<f8").reshape(states, -1) for b in sorted(rows) if b >= 0], axis=1)
        model = _next(edges, emitted.T, background)

    names = [f"e{s}" for s in range(states)]
    sums = training.select("ids", "lengths", "rare", "words").coalesce(tasks).mapInArrow(_untied_pass(single(model), head), sums_type(states))
    learned = write_shared(
        sums.groupBy("kind", "at", "word")
        .agg(F.sum("n").alias("n"), F.sum("log10").alias("log10"), *(F.sum(e).alias(e) for e in names)), "learned")
    rare = learned.where(F.col("kind") == WORD_ROW).select("word", "n", *names)
    weight = F.col("n") / (F.col("n") + F.lit(RARE_PRIOR))
    total = rare.agg(*(F.coalesce(F.sum(e), F.lit(0)).alias(e) for e in names),
                     *(F.coalesce(F.sum(F.col(e) * weight), F.lit(0.0)).alias(f"w{e}") for e in names),
                     F.coalesce(F.sum(weight), F.lit(0.0)).alias("weights")).first()
    expected = np.array([total[e] for e in names]) / FRACTION
    split = expected / expected.sum() if expected.sum() else np.full(states, 1 / states)
    weighted = np.array([total[f"w{e}"] for e in names]) / FRACTION + RARE_PRIOR * split * total["weights"]
    kept = learned.where(F.col("kind") != WORD_ROW).collect()
    if kept:
        at = {kind: np.zeros((size, states)) for kind, size in ((OWN_ROW, head), (EDGE_ROW, states + 1))}
        for r in kept:
            at[r["kind"]][r["at"]] = [r[e] / FRACTION for e in names]
        history.append(sum(r["log10"] for r in kept))
        # The tail as one last row; its add-one total makes room for the unseen.
        spread = symbols.rare_slots / symbols.rare_tokens if symbols.rare_tokens else 0.0
        model = _next(at[EDGE_ROW], np.vstack([at[OWN_ROW], expected * spread]), np.append(background[:head], background[head:].sum()))
    mass = model.emit[head:].sum(axis=0)
    return (Model(model.start, model.move, model.emit[:head]), Rare(mass, split, weighted, symbols.rare_tokens, symbols.rare_slots),
            rare, history)


SCORED = ddl("doc_id:long held_out:boolean n_tokens:long n_known:long train_tokens:long base_score:double score:double")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, passes: int = PASSES) -> DataFrame:
    """Every document's token counts, unigram base score and model score, both log10."""
    divisor, remainder = HELD_OUT
    mark = F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(divisor)) == remainder
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text"), mark.alias("held_out"))
    symbols = choose_symbols(count_words(source.where("NOT held_out")))
    encoded = encode(source, symbols)
    model, rare, learned, _ = train(encoded, symbols, states, passes)

    head, train_tokens = symbols.head, symbols.tokens
    head_counts = np.concatenate([[symbols.end_count], symbols.counts]).astype(np.float64)
    base_total = math.log10(symbols.tokens + symbols.distinct + 1)
    names = [f"e{s}" for s in range(states)]

    def run(_key: tuple, chunks: pa.Table, found: pa.Table) -> pa.Table:
        row = chunks.to_pylist()[0]
        lengths = np.frombuffer(row["lengths"], dtype="<u4").astype(np.int64)
        symbols_here = own_rows(row["ids"], row["rare"], head)
        place = found["place"].to_numpy()
        n = np.zeros(row["n_words"])
        expected = np.zeros((row["n_words"], states))
        n[place] = found["n"].to_numpy()
        for s, e in enumerate(names):
            expected[place, s] = found[e].to_numpy() / FRACTION
        counts = np.concatenate([head_counts, n])
        here = Model(model.start, model.move, np.concatenate([model.emit, rare.rows(n, expected)]))
        log10 = np.empty(len(lengths))
        for at, group in grouped(documents_of(symbols_here, row["lengths"])):
            log10[at] = group.log_likelihoods(group.forward(here)[1])
        starts = np.append(0, np.cumsum(lengths)[:-1])
        columns = {
            "doc_id": row["doc_ids"], "held_out": [row["held_out"]] * len(lengths), "n_tokens": lengths,
            "n_known": np.add.reduceat((counts > 0).astype(np.int64)[symbols_here], starts),
            "train_tokens": [train_tokens] * len(lengths),
            "base_score": np.add.reduceat(np.log10(counts + 1.0)[symbols_here], starts) - lengths * base_total, "score": log10,
        }
        schema = arrow_schema(SCORED)
        return pa.table({f.name: pa.array(columns[f.name], f.type) for f in schema}, schema=schema)

    places = encoded.select(F.col("chunk").alias("of_chunk"), F.posexplode("words").alias("place", "word"))
    found = places.join(learned, "word").select("of_chunk", "place", "n", *names)
    chunks = encoded.select("chunk", "held_out", "doc_ids", "lengths", "ids", "rare", F.size("words").alias("n_words"))
    return chunks.groupBy("chunk").cogroup(found.groupBy("of_chunk")).applyInArrow(run, SCORED)
