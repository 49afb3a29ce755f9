"""Subject areas of documents: complement naive Bayes with expectation-maximization.

A text is cut into sentences. Each sentence deals with one subject or with none;
labelled documents say which subjects theirs may have. A complement naive Bayes
model is trained from them, refined over the sentences of all documents, and the
share of a text given to each subject is turned into an independent posterior.

Words and word pairs are hashed to a fixed number of features, so the model, a
matrix of features by subjects, has a fixed size however large the corpus is;
it is all that the driver and the tasks exchange.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from criba.session import cut_lineage, worker_memory

_TAG = re.compile(r"<[a-zA-Z/][^<>]{0,200}>")
_TAG_IN_WORD = re.compile(r"(?<=\w)<[a-zA-Z/][^<>]{0,200}>(?=\w)")
_ESCAPED_BREAK = re.compile(r"\\[nrt]")
_MISREAD = re.compile("[ÂÃ][\u0080-¿Œ-™]")


@dataclass(frozen=True)
class TopicRules:
    """Parameters of ``assign_topics``.

    features      number of hashed features, a power of two
    tempers       factor of the log scores in each pass of expectation-maximization over
                  all documents; low ones first keep early posteriors undecided
    inner         steps in which a document's sentences and its mixture settle
    alpha         smoothing of the complement counts
    no_subject    prior of a sentence on no subject
    floor         prior of each subject in a document that shows none of it
    told, untold  first weight of the labelled subjects, and factor of the others
    folds         one of so many labelled documents is held out of training and calibrates the posterior
    calibrated    most held-out documents that the posterior is calibrated on
    sent          most labelled documents whose labels are sent to every task
    towards       coefficients of the posterior (constant, share, sentences) without labels;
                  a ridge pulls towards them, the more the fewer labels there are
    threshold     least posterior of a subject that is reported
    seed          of the choice of held-out documents
    chunk         characters, about, of the texts that are read together and stay together
    """

    features: int = 1 << 18
    tempers: tuple[float, ...] = (0.3, 0.3, 0.4, 0.4, 0.5, 0.5, 0.6)
    inner: int = 3
    alpha: float = 0.01
    no_subject: float = 0.2
    floor: float = 0.01
    told: float = 0.6
    untold: float = 0.05
    calibrated: int = 50_000
    towards: tuple[float, float, float] = (-5.4, 20.0, 1.0)
    threshold: float = 0.5
    folds: int = 5
    sent: int = 500_000
    seed: int = 3
    chunk: int = 1_000_000


def _mend(match: re.Match[str]) -> str:
    try:
        return match[0].encode("cp1252").decode("utf-8")
    except (UnicodeEncodeError, UnicodeDecodeError):
        return match[0]


def bare_text(text: str) -> str:
    """The text without markup and escapes, UTF-8 read as Latin mended."""
    if "&" in text:
        text = html.unescape(text)
    if "\\" in text:
        text = _ESCAPED_BREAK.sub("", text)
    if "<" in text:
        text = _TAG.sub(" ", _TAG_IN_WORD.sub("", text))
    if "Ã" in text or "Â" in text:
        text = _MISREAD.sub(_mend, text)
    return text


_NOISE, _LETTER, _DIGIT, _SPACE, _END, _BREAK = range(6)


def _character_tables() -> tuple[np.ndarray, np.ndarray]:
    """For each character of the basic plane its base letter in lower case, and its class; marks and signs are noise."""
    fold, kind = np.arange(1 << 16, dtype=np.uint64), np.zeros(1 << 16, np.uint8)
    for point in range(1 << 16):
        base = "".join(c for c in unicodedata.normalize("NFD", chr(point).lower()) if not unicodedata.combining(c))
        c = base if len(base) == 1 else chr(point)
        if not base or 0xD800 <= point < 0xE000:
            continue
        fold[point] = ord(c)
        if c in ".!?":
            kind[point] = _END
        elif c.isspace():
            kind[point] = _SPACE
        elif c.isdecimal():
            kind[point] = _DIGIT
        elif c.isalnum():
            kind[point] = _LETTER
    return fold, kind


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


@dataclass
class Read:
    """Texts as features: those of all sentences in a row, and how many sentences each text and features each sentence has."""

    features: np.ndarray
    lengths: np.ndarray
    sentences: np.ndarray


def read_texts(texts: list[str], features: int) -> Read:
    """Feature numbers of the distinct words and word pairs of every sentence, for many texts at once.

    Accents, signs and numbers are no part of words, digits inside a word neither; a
    word has at least two letters. A sentence ends at full stops, exclamation and
    question marks before white space. Sentences without words are none. All steps
    are array operations on characters; words are hashed by their letters.
    """
    fold, kind = worker_memory("topics-characters", _character_tables)
    bare = [bare_text(t) for t in texts]
    points = np.frombuffer(("\0".join(bare) + "\0").encode("utf-32-le", "replace"), np.uint32)
    ends = np.cumsum(np.fromiter(map(len, bare), np.int64, len(bare)) + 1) - 1
    points = np.where(points < 1 << 16, points, 0)
    kinds = kind[points]
    kinds[ends] = _BREAK
    keep = kinds != _NOISE
    points, kinds = fold[points[keep]], kinds[keep]
    # Digits between letters leave their word in one piece.
    digit = np.diff(np.r_[0, (kinds == _DIGIT).view(np.int8), 0])
    start, stop = np.flatnonzero(digit == 1), np.flatnonzero(digit == -1)
    inner = (start > 0) & (kinds[np.maximum(start - 1, 0)] == _LETTER) & (kinds[np.minimum(stop, len(kinds) - 1)] == _LETTER)
    if inner.any():
        drop = np.zeros(len(kinds) + 1, np.int8)
        drop[start[inner]], drop[stop[inner]] = 1, -1
        keep = np.cumsum(drop[:-1]) == 0
        points, kinds = points[keep], kinds[keep]
    letter = np.diff(np.r_[0, (kinds == _LETTER).view(np.int8), 0])
    start, stop = np.flatnonzero(letter == 1), np.flatnonzero(letter == -1)
    long = stop - start >= 2
    start, stop = start[long], stop[long]
    after = np.r_[kinds[1:], _BREAK]
    closes = (kinds == _BREAK) | ((kinds == _END) & ((after == _SPACE) | (after == _BREAK)))
    place = np.cumsum(closes)[start] if len(start) else np.empty(0, np.int64)
    text = np.cumsum(kinds == _BREAK)[start] if len(start) else np.empty(0, np.int64)
    if not len(start):
        return Read(np.empty(0, np.int32), np.empty(0, np.int32), np.zeros(len(texts), np.int32))
    powers = np.cumprod(np.full(int((stop - start).max()), 0x100000001B3, np.uint64))
    size = stop - start
    offset = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    word = _mixed(np.add.reduceat(points[np.repeat(start, size) + offset] * powers[offset], np.cumsum(size) - size))
    fresh = np.r_[True, np.diff(place) != 0]
    sentence = np.cumsum(fresh) - 1
    joined = ~fresh[1:]
    pair = _mixed(word[:-1][joined] * np.uint64(3) + word[1:][joined] + np.uint64(1))
    mask = np.uint64(features - 1)
    keys = np.concatenate([sentence, sentence[1:][joined]]) * features + (np.concatenate([word, pair]) & mask).astype(np.int64)
    keys.sort()
    keys = keys[np.r_[True, keys[1:] != keys[:-1]]]
    return Read(
        (keys & (features - 1)).astype(np.int32),
        np.bincount(keys // features, minlength=int(sentence[-1]) + 1).astype(np.int32),
        np.bincount(text[fresh], minlength=len(texts)).astype(np.int32),
    )


_CHUNKS = "k array<{kind}>, temas array<array<int>>, guardado array<boolean>, f binary, n binary, s binary"


def prepared(documents: DataFrame, key: str, text: str, told: DataFrame, rules: TopicRules) -> DataFrame:
    """Chunks of documents: keys, labels and features.

    A row holds the documents of about ``chunk`` characters as plain number arrays: ``f`` features of
    all sentences, ``n`` features of each sentence, ``s`` sentences of each
    document. ``guardado`` marks labelled documents held out of training.
    """
    kind = dict(documents.dtypes)[key]
    # Labels of a checked number go to the tasks, so that no text moves for them.
    small = told.count() <= rules.sent
    labelled = documents.select(F.col(key).alias("k"), F.col(text).alias("t")).where("k is not null and t is not null").join(F.broadcast(told) if small else told, "k", "left")
    held = F.coalesce(F.col("temas").isNotNull() & (F.pmod(F.xxhash64(F.lit(rules.seed), "k"), F.lit(rules.folds)) == 0), F.lit(False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["t"].to_pylist()
            sizes = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
            cuts = np.flatnonzero(np.diff(np.r_[-1, sizes // rules.chunk])) if len(texts) else []
            for at, to in zip(cuts, np.r_[cuts[1:], len(texts)].astype(int)):
                r = read_texts(texts[at:to], rules.features)
                part = batch.slice(at, to - at)
                lists = [pa.array([part[c].to_pylist()], pa.list_(batch.schema.field(c).type)) for c in ("k", "temas", "guardado")]
                blobs = [pa.array([x.tobytes()], pa.binary()) for x in (r.features, r.lengths, r.sentences)]
                yield pa.RecordBatch.from_arrays([*lists, *blobs], names=["k", "temas", "guardado", "f", "n", "s"])

    return labelled.select("k", "t", "temas", held.alias("guardado")).mapInArrow(run, _CHUNKS.format(kind=kind))


@dataclass
class _Chunk:
    """Sentences of a chunk of documents, side by side; labels of documents as ``_labels`` makes them."""

    features: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    document: np.ndarray
    first_sentence: np.ndarray
    worded: np.ndarray


def _unpack(row) -> _Chunk:
    f, n, s = (np.frombuffer(row[c], np.int32) for c in ("f", "n", "s"))
    return _Chunk(f, np.cumsum(n, dtype=np.int64) - n, n, np.repeat(np.arange(len(s)), s), (np.cumsum(s, dtype=np.int64) - s)[s > 0], s > 0)


def _labels(row, subjects: int, rules: TopicRules) -> tuple[np.ndarray, np.ndarray]:
    """Factor of each subject (the last: none) in each document's prior, and its first weights; held-out labels are not seen."""
    many = len(row["temas"])
    allowed, first = np.ones((many, subjects + 1), np.float32), np.zeros((many, subjects + 1), np.float32)
    for i, (told, held) in enumerate(zip(row["temas"], row["guardado"])):
        if told is None or held:
            continue
        told = [t for t in told if t < subjects]
        allowed[i, :subjects] = rules.untold
        allowed[i, told] = 1
        first[i, told] = rules.told / max(1, len(told))
        first[i, subjects] = 1 - rules.told if told else 1
    return allowed, first


def _posteriors(b: _Chunk, model: np.ndarray, temper: float, rules: TopicRules, allowed: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each sentence and the sums by document; ``allowed``: labels limit the subjects."""
    many = model.shape[1]
    docs, subjects = len(b.worded), many - 1
    score = np.add.reduceat(model[b.features], b.starts, axis=0) * np.float32(temper)
    sums = np.zeros((docs, many), np.float32)
    mixture = np.full((docs, subjects), 1 / subjects, np.float32)
    post = score
    for _ in range(rules.inner):
        on_subject = (mixture + rules.floor) / (1 + rules.floor * subjects) * (1 - rules.no_subject)
        prior = np.concatenate([on_subject, np.full((docs, 1), rules.no_subject)], axis=1).astype(np.float32)
        post = score + np.log(prior if allowed is None else prior * allowed)[b.document]
        post -= post.max(axis=1, keepdims=True)
        np.exp(post, out=post)
        post /= post.sum(axis=1, keepdims=True)
        sums[b.worded] = np.add.reduceat(post, b.first_sentence, axis=0)
        mixture = sums[:, :-1] / np.maximum(sums[:, :-1].sum(axis=1, keepdims=True), 1e-9)
    return post, sums


def complement_model(counts: np.ndarray, alpha: float) -> np.ndarray:
    """Complement naive Bayes weights of a matrix of features by subjects, centred by feature.

    The weight of a feature for a subject is minus the log of its smoothed share in
    all other subjects, so that a rich subject does not crowd out a poor one. Made
    subject by subject, as the matrix is the largest thing that the driver holds.
    """
    total = counts.sum(axis=1, dtype=np.float64)
    everything, own = total.sum(), counts.sum(axis=0, dtype=np.float64)
    model = np.empty(counts.shape, np.float32)
    for c in range(counts.shape[1]):
        rest = np.maximum(total - counts[:, c], 0) + alpha
        model[:, c] = np.log(everything - own[c] + alpha * len(counts)) - np.log(rest)
    model -= model.mean(axis=1, keepdims=True)
    return model


def _count(chunks: DataFrame, subjects: int, rules: TopicRules, model: np.ndarray | None, temper: float = 1.0) -> np.ndarray:
    """Expected feature counts by subject: of the labels at first, then of the posteriors under ``model``.

    Each task adds up one matrix of the model's size and hands it on in blocks of
    features; blocks are added up in parallel, and their sums make the next model.
    """
    shared = chunks.sparkSession.sparkContext.broadcast(model)
    block = min(rules.features, 1 << 13)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((subjects + 1, rules.features), np.float32)
        for batch in batches:
            for row in batch.to_pylist():
                b = _unpack(row)
                if not len(b.features):
                    continue
                allowed, first = _labels(row, subjects, rules)
                post = first[b.document] if shared.value is None else _posteriors(b, shared.value, temper, rules, allowed)[0]
                for c in range(subjects + 1):
                    counts[c] += np.bincount(b.features, weights=np.repeat(post[:, c], b.lengths), minlength=rules.features)
        counts = counts.T
        for at in range(0, rules.features, block):
            if counts[at : at + block].any():
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([counts[at : at + block].tobytes()], pa.binary())], names=["f", "x"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), np.float32).astype(np.float64) for x in group["x"])
        return pa.table({"f": group["f"][:1], "x": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    out = np.zeros((rules.features, subjects + 1), np.float32)
    # Of fixed size, whatever the corpus holds.
    for at, data in chunks.select("temas", "guardado", "f", "n", "s").mapInArrow(run, "f int, x binary").groupBy("f").applyInArrow(add, "f int, x binary").collect():
        out[at : at + block] = np.frombuffer(data, np.float32).reshape(block, subjects + 1)
    # Collected already: neither the driver nor the tasks need this model any more.
    shared.destroy()
    return out


def _add_seed(counts: np.ndarray, names: dict[int, list[str]], rules: TopicRules) -> np.ndarray:
    """``counts`` with those from the subjects' own names and descriptions, as if each stood in a few sentences."""
    for i, texts in names.items():
        if texts:
            np.add.at(counts[:, i], read_texts(texts, rules.features).features, 3)
    return counts


def _calibrate(share: np.ndarray, mass: np.ndarray, told: np.ndarray, towards: tuple[float, float, float] = TopicRules.towards) -> np.ndarray:
    """Coefficients of a logistic posterior on the share of a text and the sentences given to a subject.

    Annotators leave subjects out and name wrong ones: two rates of such slips are
    estimated along with the coefficients, by expectation-maximization, so that
    slips do not pass for doubt about the shares. Labels that are all alike, or none, don't say where
    to divide and leave the coefficients at ``towards``.
    """
    x = _evidence(share, mass)
    w = np.array(towards, float)
    if told.all() or not told.any():
        return w
    start, missed, wrong = w.copy(), 0.1, 0.02
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        yes, no = p * np.where(told, 1 - missed, missed), (1 - p) * np.where(told, wrong, 1 - wrong)
        real = yes / (yes + no)
        # A few imagined labels keep the rates off the ends.
        missed = (real[~told].sum() + 1) / (real.sum() + 10)
        wrong = ((1 - real)[told].sum() + 1) / ((1 - real).sum() + 50)
        slope = x.T @ (real - p) - (w - start)
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.eye(3)
        step = np.linalg.solve(curve, slope)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-4:
            break
    return w


def _evidence(share: np.ndarray, mass: np.ndarray) -> np.ndarray:
    # Beyond a half more share says nothing new; the same holds for a full sentence.
    return np.stack([np.ones_like(share), np.minimum(share, 0.5), np.minimum(mass, 1.0)], axis=1)


def topic_posteriors(documents: DataFrame, key: str, text: str, labels: DataFrame, label: str, subjects: DataFrame, rules: TopicRules = TopicRules()) -> DataFrame:
    """Posterior of every subject for every document that has words: ``key, tema, parte, posterior``.

    documents: ``key`` and ``text``; labels: ``key`` and ``label``, several rows a
    document, a null label where the annotator saw no subject; subjects: a small
    fixed table whose first column is the subject and whose other columns are words
    about it. ``parte`` is the share of the text's sentences on any subject.

    Null, empty and wordless texts have no rows. Labels of unknown subjects or
    documents are ignored; without labels the subjects' own words start the model.
    Copies of a text get equal results. Rows without key are ignored.
    """
    names = [r[0] for r in subjects.select(F.col(subjects.columns[0]).alias("s")).where("s is not null").distinct().orderBy("s").collect()]
    about = {i: [] for i in range(len(names))}
    for row in subjects.collect():
        if row[0] is not None:
            about[names.index(row[0])] += [str(v) for v in row[1:] if v is not None]
    many = len(names)
    kind = dict(documents.dtypes)[key]
    if not many:
        return documents.sparkSession.createDataFrame([], f"`{key}` {kind}, tema string, parte double, posterior double")
    place = F.coalesce(*[F.when(F.col(label) == n, i) for i, n in enumerate(names)], F.when(F.col(label).isNull(), many))
    told = labels.select(F.col(key).alias("k"), place.alias("i")).where("k is not null and i is not null").groupBy("k").agg(F.sort_array(F.collect_set("i")).alias("temas"))
    chunks = cut_lineage(prepared(documents, key, text, told, rules))
    # A task a core: each hands on one matrix of the model's size, however many documents it counts.
    few = chunks.coalesce(max(1, chunks.sparkSession.sparkContext.defaultParallelism))

    model = None
    for temper in (1.0, *rules.tempers):
        model = complement_model(_add_seed(_count(few, many, rules, model, temper), about, rules), rules.alpha)
    shared = chunks.sparkSession.sparkContext.broadcast(model)
    types = f"k {kind}, i int, parte float, peso float, dicho boolean"

    def shares(held_only: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys_type = batch.schema.field("k").type.value_type
                for row in batch.to_pylist():
                    if held_only and not any(row["guardado"]):
                        continue
                    b = _unpack(row)
                    if not len(b.features):
                        continue
                    mass = _posteriors(b, shared.value, rules.tempers[-1], rules, None)[1][:, :many]
                    share = mass / np.maximum(mass.sum(axis=1, keepdims=True), 1e-9)
                    kept = b.worded & np.array(row["guardado"], bool) if held_only else b.worded
                    doc, subject = np.divmod(np.arange(len(kept) * many)[np.repeat(kept, many)], many)
                    told = np.zeros((len(kept), many), bool)
                    for i in np.flatnonzero(kept) if held_only else ():
                        told[i, [t for t in row["temas"][i] if t < many]] = True
                    keys = pa.array(row["k"], keys_type).take(pa.array(doc))
                    yield pa.RecordBatch.from_arrays([keys, pa.array(subject.astype(np.int32)), pa.array(share[doc, subject]), pa.array(mass[doc, subject]), pa.array(told[doc, subject])], names=["k", "i", "parte", "peso", "dicho"])

        return run

    # Only documents whose labels the model has not seen tell how far its shares are to be trusted.
    sample = chunks.where(F.exists("guardado", lambda g: g)).mapInArrow(shares(True), types)
    judged = sample.orderBy(F.xxhash64("k"), "k", "i").limit(rules.calibrated * many).select("parte", "peso", "dicho").toPandas()
    w = _calibrate(judged["parte"].to_numpy(float), judged["peso"].to_numpy(float), judged["dicho"].to_numpy(float) > 0.5, rules.towards)
    logit = F.lit(float(w[0])) + float(w[1]) * F.least("parte", F.lit(0.5)) + float(w[2]) * F.least("peso", F.lit(1.0))
    subject = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("i") + 1)
    found = chunks.mapInArrow(shares(False), types)
    return found.select(F.col("k").alias(key), subject.alias("tema"), F.col("parte").cast("double").alias("parte"), (1 / (1 + F.exp(-logit))).alias("posterior"))


def assign_topics(documents: DataFrame, key: str, text: str, labels: DataFrame, label: str, subjects: DataFrame, rules: TopicRules = TopicRules()) -> DataFrame:
    """The subjects of each document: rows of ``topic_posteriors`` at or above the threshold."""
    return topic_posteriors(documents, key, text, labels, label, subjects, rules).where(F.col("posterior") >= rules.threshold)
