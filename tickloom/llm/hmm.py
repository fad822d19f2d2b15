"""A hidden Markov language model trained by Baum-Welch, with exact sequence likelihoods.

The states emit symbols: the words most frequent in all training texts have one each, all
others share ``BUCKETS`` symbols by hash, and within its bucket a word has the probability
(c + 1) / (N_b + V_b + 1), c being its count in all training texts, N_b and V_b the words
and distinct words of the bucket. So the state tables stay small however large the
vocabulary is, and the likelihood of a text is that of its symbols (scaled forward
recursion over the whole text) times that of its words within their buckets.

The texts are turned into symbols once. Rare words go to shards by hash, packed with the
text they come from, as many shards as their size asks for; a shard has all occurrences of its
words, counts those of training texts and sends the counts back. No word that has a shard is frequent, so no shard is hot.
Every round of Baum-Welch goes over all training texts, whole ones, from a start that no text
decides; all but the last extrapolate, which reaches in 13 rounds what 22 plain ones do. Expected counts are summed within tasks, then by symbol; only the tables come to
the driver.
"""

from __future__ import annotations

import contextlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import words
from tickloom.llm.text import even_keys, shuffles, stored

FREQUENT = 32_768
BUCKETS = 4_096
STATES = 8
ROUNDS = 13
STRIDE = 1.8  # all rounds but the last go this many times the way to their estimate; 1 is plain Baum-Welch
TEXTS, WINDOW, KEPT, SCALE = 4096, 1 << 16, 1 << 18, 4  # sizes of the work on expected counts, which change no result
SHARD_BYTES = 64 << 20  # of rare words' hashes, at most, in a shard on average
END = np.uint64(0x51ED270B9F0C3A7D)  # the hash that stands for the end of a text

_CODED = "doc_id {id}, held_out boolean, n_tokens long, symbols binary, rare binary, uid long"


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return ((hashes >> np.uint64(20)) % np.uint64(BUCKETS)).astype(np.int64)


def _tokens(column: pa.Array):
    """For blocks of texts: token hashes, each text's followed by END, and the bounds of texts."""
    for block in words.blocks(column, lower=True):
        bounds = block.first + np.arange(block.texts + 1)
        hashes = np.full(bounds[-1], END)
        hashes[np.arange(len(block.hashes)) + np.repeat(np.arange(block.texts), block.counts)] = block.hashes
        yield hashes, bounds


def _symbols(hashes: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbol of each token and whether it is a rare word's; ``frequent`` is sorted."""
    at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
    rare = frequent[at] != hashes
    return np.where(rare, len(frequent) + _bucket(hashes), at).astype(np.uint16), rare


def _count(batches):
    for batch in batches:
        for hashes, _ in _tokens(batch.column(0)):
            word, n = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_pydict({"word": words.as_longs(word), "n": n})


def _frequent(texts: DataFrame, most: int) -> np.ndarray:
    """The words that occur more often than the one of rank ``most`` + 1, counted over all texts."""
    counts = texts.mapInArrow(_count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = stored(counts, "words")
    sizes = counts.groupBy("n").agg(F.count("*").alias("words")).toArrow()  # few: one row per count that occurs
    n = sizes.column("n").to_numpy()
    down = np.argsort(-n)
    over = np.flatnonzero(np.cumsum(sizes.column("words").to_numpy()[down]) > most)
    least = int(n[down[over[0]]]) if len(over) else 0
    return counts.where(F.col("n") > least).select("word").toArrow().column("word").to_numpy().astype(np.int64)


def _encode(frequent):
    def run(batches):
        for batch in batches:
            n, symbols, rare = [], [], []
            for hashes, bounds in _tokens(batch.column(2)):
                found, unusual = _symbols(hashes, frequent)
                left = np.concatenate(([0], np.cumsum(unusual)))[bounds]
                others = hashes[unusual]
                for (a, b), (c, d) in zip(itertools.pairwise(bounds), itertools.pairwise(left), strict=True):
                    n.append(b - a)
                    symbols.append(found[a:b].tobytes())
                    rare.append(others[c:d].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(symbols, pa.binary()), pa.array(rare, pa.binary())],
                ["doc_id", "held_out", "n_tokens", "symbols", "rare"],
            )

    return run


def _joined(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = words.raw_bytes(column)
    width = np.dtype(kind).itemsize
    return np.frombuffer(data[offsets[0] : offsets[-1]].tobytes(), kind), (offsets - offsets[0]) // width


# The model: start (K), chain (K, K) and emit (symbols, K) probabilities.


def _steps(symbols, likely, start, chain, first, begin, before, token, emits, alpha):
    """The forward recursion over a window of steps of texts sorted by length.

    ``begin`` has where each step's tokens begin among those of the whole texts, ``before`` the last
    step's state probabilities. Fills the window's symbols, emissions and state probabilities, step
    after step, and returns the row sums that the probabilities of each ``SCALE``-th step were divided by.
    """
    low, place = begin[0], [x - begin[1][0] for x in begin[1]]
    for t, (a, b) in enumerate(itertools.pairwise(place), low):
        np.add(first[: b - a], t, out=token[a:b])
    token[:] = symbols.take(token)
    likely.take(token, 0, out=emits, mode="clip")
    ones, scales = np.ones_like(chain), []
    for t, (a, b) in enumerate(itertools.pairwise(place), low):
        now = alpha[a:b]
        if t:
            np.matmul(before[: b - a], chain, out=now)
            now *= emits[a:b]
        else:
            np.multiply(start, emits[a:b], out=now)
        if (t - low) % SCALE == 0:
            scales.append(now @ ones)
            now /= scales[-1]
        before = now
    return scales


def expected(model, symbols: np.ndarray, bounds: np.ndarray, totals) -> None:
    """Adds the expected counts of whole texts to totals (start, chain, emit).

    All texts take a step at a time, longest first. The steps are cut into windows of ``WINDOW``
    tokens, which fit the cache; the state is carried forward over whole texts, keeping its
    probabilities at the end of each window, then the windows are gone through from the last to the
    first. Emissions are taken relative to the largest of their symbol, which cancels out. Single
    precision is enough for the ``SCALE`` steps between scalings; sums are in double precision.
    """
    start, chain = (x.astype(np.float32) for x in model[:2])
    likely = (model[2] / model[2].max(1, keepdims=True)).astype(np.float32)
    back, ones = np.ascontiguousarray(chain.T), np.ones_like(chain)
    length, moves = np.diff(bounds), np.zeros(chain.shape)
    order = np.argsort(-length, kind="stable")
    order = order[: np.count_nonzero(length)]
    most = max(WINDOW, min(TEXTS, len(order)))  # tokens of a window: one step at least
    token, shares = np.empty(KEPT + most, np.int64), np.empty((KEPT + most, len(start)), np.float32)
    emits, room = (np.empty((n, len(start)), np.float32) for n in (most, min(TEXTS, len(order))))
    used = 0

    for at in range(0, len(order), TEXTS):
        first, size = bounds[order[at : at + TEXTS]], length[order[at : at + TEXTS]]
        live = np.searchsorted(-size, -np.arange(int(size[0]) + 1), side="left")
        begin = np.concatenate(([0], np.cumsum(live)))
        cuts = [0]
        while cuts[-1] < size[0]:
            far = int(np.searchsorted(begin, begin[cuts[-1]] + WINDOW, side="right")) - 1
            cuts.append(min(int(size[0]), max(far, cuts[-1] + 1)))
        heads = [None]

        def forward(w):
            steps = cuts[w], begin[cuts[w] : cuts[w + 1] + 1].tolist()  # noqa: B023
            n = steps[1][-1] - steps[1][0]
            x, alpha = token[used : used + n], shares[used : used + n]  # noqa: B023
            return x, alpha, _steps(symbols, likely, start, chain, first, steps, heads[w], x, emits[:n], alpha)  # noqa: B023

        for w in range(len(cuts) - 2):
            alpha = forward(w)[1]
            heads.append(alpha[-live[cuts[w + 1] - 1] :].copy())
        after = None  # what follows a token: its emission times the rest of the text, per state
        for w in range(len(cuts) - 2, -1, -1):
            x, alpha, scales = forward(w)
            end = len(x)
            for t in range(cuts[w + 1] - 1, cuts[w] - 1, -1):
                n, m = live[t], live[t + 1]
                here, beta = alpha[end - n : end], room[:n]
                if m:
                    np.matmul(after, back, out=beta[:m])
                    if t == cuts[w + 1] - 1:
                        scale = (here[:m] * beta[:m]) @ ones
                        beta[:m] /= scale
                        after /= scale
                    moves += here[:m].T @ after
                if n > m:
                    np.divide(1, here[m:] @ ones, out=beta[m:])
                after = emits[end - n : end]
                after *= beta
                here *= beta
                if (t - cuts[w]) % SCALE == 0:
                    after /= scales[(t - cuts[w]) // SCALE]
                end -= n
            after = after.copy()
            used += len(x)
            if used >= KEPT:
                _add_shares(totals[2], token[:used], shares[:used])
                used = 0
        totals[0] += alpha[: live[0]].sum(0)
    _add_shares(totals[2], token[:used], shares[:used])
    totals[1] += moves * model[1]


def _add_shares(emit: np.ndarray, token: np.ndarray, shares: np.ndarray) -> None:
    for k in range(emit.shape[1]):
        emit[:, k] += np.bincount(token, shares[:, k], len(emit))


def _empty(states: int, symbols: int):
    return [np.zeros(states), np.zeros((states, states)), np.zeros((symbols, states))]


def normalised(totals, unigram: np.ndarray):
    """Probabilities from expected counts, a little of the unigram mixed into each state."""
    start, chain, emit = totals
    emit = emit + unigram[:, None] * (1.0 + 0.01 * emit.sum(0))
    chain = chain + 0.1
    return (start + 0.1) / (start + 0.1).sum(), chain / chain.sum(1, keepdims=True), emit / emit.sum(0)


def advanced(model, found, stride: float):
    """The model that lies ``stride`` times as far from ``model`` as the estimate ``found``, in logarithms.

    Between 1 and 2 this reaches the same optimum as plain rounds in fewer of them, as each estimate
    undershoots. The last round of a training is a plain one, which cannot overshoot. No state gives a
    symbol less than a millionth of what another gives it, so that a few steps never underflow.
    """
    start, chain, emit = (y * (y / x) ** (stride - 1) for x, y in zip(model, found, strict=True))
    emit = np.maximum(emit, 1e-6 * emit.max(1, keepdims=True))
    return start / start.sum(), chain / chain.sum(1, keepdims=True), emit / emit.sum(0)


def start_model(unigram: np.ndarray, states: int):
    """States that seldom change and each lean to other symbols, by fixed random weights."""
    emit = unigram[:, None] * np.random.RandomState(7).uniform(0.5, 1.5, (len(unigram), states))
    chain = 0.9 * np.eye(states) + 0.1 / states
    return np.full(states, 1 / states), chain, emit / emit.sum(0)


def first_model(symbols, bounds, unigram, states, rounds):
    """The training of :func:`score_texts` over texts in memory."""
    model = start_model(unigram, states)
    for left in range(rounds, 0, -1):
        totals = _empty(states, len(unigram))
        expected(model, symbols, bounds, totals)
        model = advanced(model, normalised(totals, unigram), STRIDE if left > 1 else 1.0)
    return model


def likelihoods(model, symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """log10 probability of each whole sequence, by the scaled forward recursion."""
    start, *_, chain, emit = model
    length = np.diff(bounds)
    order = np.argsort(-length, kind="stable")
    first, size = bounds[:-1][order], length[order]
    out, now = np.zeros(len(size)), np.broadcast_to(start, (len(size), len(start)))
    live = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), side="left")
    for t, n in enumerate(live.tolist()):
        now = (now[:n] if t == 0 else now[:n] @ chain) * emit[symbols[first[:n] + t]]
        total = now.sum(1)
        out[:n] += np.log10(total)
        now /= total[:, None]
    back = np.empty_like(out)
    back[order] = out
    return back


def _expect(model):
    def run(batches):
        totals = _empty(len(model[0]), len(model[2]))
        for batch in batches:
            expected(model, *_joined(batch.column(0), np.uint16), totals)
        used = np.flatnonzero(totals[2].any(1))
        place = np.concatenate((used, -1 - np.arange(len(model[0]) + 1)))
        table = np.concatenate((totals[2][used], totals[1], totals[:1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(place), *(pa.array(x) for x in table.T)], ["place", *(f"k{k}" for k in range(table.shape[1]))]
        )

    return run


def _trained(coded: DataFrame, model, unigram, stride: float):
    """One round of Baum-Welch over all training texts."""
    states = [f"k{k}" for k in range(len(model[0]))]
    task = coded.mapInArrow(_expect(model), "place long, " + ", ".join(f"{k} double" for k in states))
    found = task.groupBy("place").agg(*(F.sum(k).alias(k) for k in states)).toArrow()
    place = found.column("place").to_numpy()
    table = np.stack([found.column(k).to_numpy() for k in states], 1)
    totals = _empty(len(states), len(unigram))
    totals[2][place[place >= 0]] = table[place >= 0]
    rest = {int(-1 - p): row for p, row in zip(place, table, strict=True) if p < 0}
    if not rest:
        return model
    totals[1] = np.stack([rest[k] for k in range(len(states))])
    totals[0] = rest[len(states)]
    return advanced(model, normalised(totals, unigram), stride)


@contextlib.contextmanager
def _shuffles_removed(spark: SparkSession):
    """While it lasts, a query's shuffle files go when it ends, so that rounds do not fill the disks."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _symbol_counts(size):
    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_joined(batch.column(0), np.uint16)[0], minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"symbol": used, "n": total[used]})

    return run


def _consecutive(uid: np.ndarray, most: int):
    """Runs of at most ``most`` rows whose uids follow one another."""
    cuts = np.append(np.flatnonzero(np.diff(uid, prepend=-2) != 1), len(uid))
    for a, b in itertools.pairwise(cuts):
        for at in range(a, b, most):
            yield at, min(b, at + most)


def _to_shards(shards):
    """(shard, uids, held, row, hash): the rare words of a batch of texts that go to each shard."""

    def run(batches):
        for whole in batches:
            for a, b in _consecutive(whole.column(0).to_numpy(), 4096):
                batch = whole.slice(a, b - a)
                hashes, bounds = _joined(batch.column(1), np.uint64)
                row = np.repeat(np.arange(batch.num_rows), np.diff(bounds)).astype(np.uint16)
                shard = ((hashes >> np.uint64(36)) % np.uint64(len(shards))).astype(np.uint32)
                order = np.argsort(shard.astype(np.uint16) if len(shards) <= 65536 else shard, kind="stable")
                hashes, row, shard = hashes[order], row[order], shard[order]
                uid, held = batch.column(0).to_numpy(), np.asarray(batch.column(2))
                cuts = np.append(np.flatnonzero(np.diff(shard.astype(int), prepend=-1)), len(shard))
                for a, b in itertools.pairwise(cuts):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shards[shard[a]]], pa.int64()), pa.array([int(uid[0])], pa.int64()),
                         pa.array([np.packbits(held).tobytes()], pa.binary()),
                         pa.array([row[a:b].tobytes()], pa.binary()), pa.array([hashes[a:b].tobytes()], pa.binary())],
                        ["shard", "uid", "held", "row", "hash"],
                    )

    return run


def _counted(table: pa.Table) -> pa.Table:
    """(home, uid, row, n): for each rare word of a batch its count in training texts. One row
    more, with home -1, has the shard's buckets and how many distinct words each has."""
    rows = table.to_pylist()
    hashes = [np.frombuffer(r["hash"], np.uint64) for r in rows]
    row = [np.frombuffer(r["row"], np.uint16) for r in rows]
    train = [np.unpackbits(np.frombuffer(r["held"], np.uint8))[x] == 0 for r, x in zip(rows, row, strict=True)]
    word, back = np.unique(np.concatenate(hashes), return_inverse=True)
    count = np.bincount(back, np.concatenate(train), len(word)).astype(np.int64)
    bucket, distinct = np.unique(_bucket(word[count > 0]), return_counts=True)
    found = np.split(count[back], np.cumsum([len(x) for x in hashes])[:-1])
    out = [(r["uid"] >> 33, r["uid"], r["row"], n.astype(np.uint32).tobytes()) for r, n in zip(rows, found, strict=True)]
    out.append((-1, -1, bucket.astype(np.uint16).tobytes(), distinct.astype(np.uint32).tobytes()))
    kinds = (("home", pa.int64()), ("uid", pa.int64()), ("row", pa.binary()), ("n", pa.binary()))
    return pa.table({k: pa.array(x, t) for (k, t), x in zip(kinds, zip(*out, strict=True), strict=True)})


def _distinct(batches):
    """(bucket, n): a task's sums of the shards' distinct words."""
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for bucket, n in zip(batch.column(0), batch.column(1), strict=True):
            total[np.frombuffer(bucket.as_buffer(), np.uint16)] += np.frombuffer(n.as_buffer(), np.uint32)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"bucket": used, "n": total[used]})


def _word_sums(table: pa.Table) -> pa.Table:
    """(uid, known, logs): known rare words and the sum of log10(c + 1) per text."""
    uid, n = [], []
    for r in table.select(["uid", "row", "n"]).to_pylist():
        uid.append(r["uid"] + np.frombuffer(r["row"], np.uint16).astype(np.int64))
        n.append(np.frombuffer(r["n"], np.uint32))
    text, back = np.unique(np.concatenate(uid), return_inverse=True)
    n = np.concatenate(n)
    return pa.table({"uid": text, "known": np.bincount(back, n > 0).astype(np.int64), "logs": np.bincount(back, np.log10(n + 1.0))})


def _scored(model, counts, total, vocabulary, inside):
    """Per text: known frequent words, base score without rare words' counts, model's score without them."""
    frequent = len(counts) - BUCKETS
    unit = np.log10(float(total + vocabulary + 1))
    base = np.where(np.arange(len(counts)) < frequent, np.log10(counts + 1.0), 0.0)
    seen = np.where(np.arange(len(counts)) < frequent, counts > 0, False).astype(float)

    def run(batches):
        for batch in batches:
            symbols, bounds = _joined(batch.column(1), np.uint16)
            text = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            add = lambda table: np.bincount(text, table[symbols], batch.num_rows)  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(add(seen).astype(np.int64)), pa.array(add(base) - np.diff(bounds) * unit),
                 pa.array(likelihoods(model, symbols, bounds) + add(inside))],
                ["uid", "frequent_known", "base", "model"],
            )

    return run


def score_texts(
    docs: DataFrame, held_out: Column, states: int = STATES, rounds: int = ROUNDS, frequent: int = FREQUENT
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    Learns from the rows where ``held_out`` is false. Tokens are the words, A-Z lower-cased,
    and one end; null and empty texts are the end alone. base_score is the add-one unigram's
    log10 probability, score the model's. Repeated rows count and score one by one, a null id
    is carried along, an empty table gives an empty result, and without training texts every
    word is unknown. Other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out.alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    train = rows.where(~F.col("held_out"))
    top = _frequent(train.select("text"), frequent)
    known = np.sort(np.union1d(top.view(np.uint64), [END]))
    size = len(known) + BUCKETS
    if size > 1 << 16:
        raise ValueError(f"frequent must be below {(1 << 16) - BUCKETS}: symbols have 16 bits")
    shape = _CODED.format(id=kind)
    coded = rows.mapInArrow(_encode(known), shape.rsplit(",", 1)[0])
    coded = stored(coded.withColumn("uid", F.monotonically_increasing_id()), "coded")
    training = coded.where(~F.col("held_out")).select("symbols")

    found = training.mapInArrow(_symbol_counts(size), "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n"))
    found, counts = found.toArrow(), np.zeros(size, np.int64)
    counts[found.column("symbol").to_numpy()] = found.column("n").to_numpy()
    total = int(counts.sum())
    unigram = (counts + 1.0) / (total + size)

    model = start_model(unigram, states)
    with _shuffles_removed(docs.sparkSession):
        for left in range(rounds if total else 0, 0, -1):
            model = _trained(training, model, unigram, STRIDE if left > 1 else 1.0)

    rare = coded.agg(F.sum(F.octet_length("rare"))).first()[0] or 0
    parts = max(shuffles(docs.sparkSession), -(-rare // SHARD_BYTES))
    shards = even_keys(docs.sparkSession, parts)
    packed = coded.select("uid", "rare", "held_out").mapInArrow(
        _to_shards(shards), "shard long, uid long, held binary, row binary, hash binary"
    )
    packed = packed.repartition(parts, "shard")
    back = stored(packed.groupBy("shard").applyInArrow(_counted, "home long, uid long, row binary, n binary"), "counted")
    distinct = np.zeros(BUCKETS, np.int64)
    found = back.where("home < 0").select("row", "n").mapInArrow(_distinct, "bucket long, n long")
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most BUCKETS rows
        distinct[r["bucket"]] = r["n"]
    vocabulary = int((counts[: len(known)] > 0).sum() + distinct.sum())
    inside = np.concatenate((np.zeros(len(known)), -np.log10(counts[len(known) :] + distinct + 1.0)))
    sums = back.where("home >= 0").groupBy("home").applyInArrow(_word_sums, "uid long, known long, logs double")
    scored = coded.select("uid", "symbols").mapInArrow(
        _scored(model, counts, total, vocabulary, inside), "uid long, frequent_known long, base double, model double"
    )
    zero = lambda name: F.coalesce(name, F.lit(0))
    return coded.select("uid", "doc_id", "held_out", "n_tokens").join(scored, "uid").join(sums, "uid", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("frequent_known") + zero("known")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + zero("logs")).alias("base_score"),
        (F.col("model") + zero("logs")).alias("score"),
    )
