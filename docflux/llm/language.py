"""The language of every document and of every line of a mixed one, by a bidirectional gated recurrent network on bytes.

The network reads a line's bytes in both directions with light gated recurrent units (an update gate, no reset gate;
the activation is softsign, x / (1 + |x|), which numpy works out in half the time of tanh) and gives each position a
distribution over the languages; a line's evidence is the sum over its positions, a document's the sum over its lines.
It is trained in numpy by backpropagation through time on a bounded sample of rows that carry a label; as labels may be
wrong, lines on which the first pass contradicts its label are left out of the second. A share of the sample, chosen by
hash, is held out of both passes: on it the weight of a position's evidence (positions are not independent) and the cost
of a change of language are calibrated. The same sample gives the same tagger on any number of threads, and one that was
trained once is kept in the shared folder under the hash of its sample. Inference runs inside Arrow-batched tasks: lines
of like length step together, so that every byte of every text is read.

A text is mixed if the best path over its lines, which begins and ends in the text's main language, changes it. A line
counts by its words (capitalised ones half, addresses and numbers not), so that a heading or a contact line alone doesn't
make a text mixed. NULL texts are left out; empty and blank texts have no language (NULL, confidence 0).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflux.session import finished, shared_dir, spread

#: Raised whenever training changes, so that taggers kept by an older version aren't used.
VERSION = 4
LANGUAGES = ("en", "id", "ms", "vi", "th", "tl", "fr", "de")
#: Units a direction; bytes of a training window; windows a batch; batches of the two passes.
UNITS, WINDOW, BATCH, STEPS = 32, 80, 64, (500, 1000)
#: Bound of the training sample: labelled rows a language, and lines of each; one row in HELD_OUT is for calibration only.
SAMPLE_ROWS, SAMPLE_LINES, HELD_OUT = 600, 8, 5
#: Most of a label's lines that the second pass may leave out.
WRONG_LABELS = 0.15
#: Bytes of a line that step in one go, bytes before and after them that are read as well, positions of an inference batch.
PART, CONTEXT, POSITIONS = 1536, 64, 1_500_000
#: Lines of an inference batch at most; the same in training, where products must be so small that they aren't split among
#: threads, which would round otherwise; positions whose scores are summed at once.
ROWS, FEW_ROWS, STRIDE = 1024, 256, 8
#: Candidates for the weight of a position's log-probability, and bounds of the cost of a change (nats).
WEIGHTS, CHANGES = (0.02, 0.04, 0.06, 0.08, 0.1, 0.15, 0.2, 0.3, 0.45, 0.7, 1.0), (4.0, 7.0)
#: Lines of a text up to which one with words outweighs, as its main language, all without (best_path counts those a thousandth each).
ALIKE = 400
#: Characters of words (see plain_length) from which a line counts in full (it then outweighs two changes by FULL); fewer count in proportion.
FULL_LINE, FULL = 60, 1.2

_DIGIT = re.compile(r"\d")
_PLACE = re.compile(r"[^\s@＠]*[@＠]\S*|(?:https?://|www\.)\S+")
_WORD = re.compile(r"[^\W\d_][^\s\d]*")


def without_places(line: str) -> str:
    """A line without its e-mail and web addresses; only lines that can hold one are searched."""
    return _PLACE.sub(" ", line) if "@" in line or "＠" in line or "://" in line or "www." in line else line


def normal_bytes(line: str) -> bytes:
    """What the network reads of a line: lower case, digits as 0, no addresses, white space folded, a space before and after."""
    return (" " + _DIGIT.sub("0", " ".join(without_places(line).lower().split())) + " ").encode("utf-8", errors="replace")


def plain_length(line: str) -> float:
    """Characters of a line's words, half for capitalised ones (names, headings) unless the line is in capitals; none for addresses and numbers."""
    line = without_places(line)
    line = line.lower() if line.isupper() else line
    words = _WORD.findall(line)
    return sum(map(len, words)) - sum([len(w) for w in words if w[0] != w[0].lower()]) / 2


def has_words(line: str) -> bool:
    """Whether plain_length isn't 0."""
    return _WORD.search(without_places(line)) is not None


class ByteTagger:
    """A bidirectional light GRU over bytes with a softmax at every position."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None, seed: int = 7):
        if weights is None:
            rng = np.random.default_rng(seed)
            h = UNITS
            weights = {}
            for d in "fb":
                weights[f"E{d}"] = (rng.standard_normal((256, 2 * h)) * 0.3).astype(np.float32)
                weights[f"U{d}"] = (rng.standard_normal((h, 2 * h)) / np.sqrt(h)).astype(np.float32)
                weights[f"W{d}"] = (rng.standard_normal((h, len(LANGUAGES))) / np.sqrt(h)).astype(np.float32)
                weights[f"E{d}"][:, :h] -= 0.5  # gates begin rather closed: a longer memory
            weights["b"] = np.zeros(len(LANGUAGES), np.float32)
        self.w = dict(weights)
        #: Weight of a position's log-probability and cost of a change of language.
        self.calibration = tuple(map(float, self.w["calibration"])) if "calibration" in self.w else (0.15, 5.0)

    # ------------------------------------------------------------ training
    def _forward(self, x: np.ndarray, d: str) -> tuple[np.ndarray, np.ndarray]:
        t, b = x.shape
        h = UNITS
        acts, hs = np.empty((t, b, 2 * h), np.float32), np.zeros((t + 1, b, h), np.float32)
        e, u = self.w[f"E{d}"], self.w[f"U{d}"]
        for i in range(t):
            a = np.matmul(hs[i], u, out=acts[i])
            a += e[x[i]]
            a /= 1 + np.abs(a)
            hs[i + 1] = hs[i] + (0.5 * a[:, :h] + 0.5) * (a[:, h:] - hs[i])
        return acts, hs

    def _backward(self, x: np.ndarray, d: str, acts: np.ndarray, hs: np.ndarray, dout: np.ndarray, grads: dict) -> None:
        t, b = x.shape
        h = UNITS
        u = self.w[f"U{d}"]
        da = np.empty((t, b, 2 * h), np.float32)
        dh, du = np.zeros((b, h), np.float32), np.zeros_like(u)
        for i in range(t - 1, -1, -1):
            dh = dh + dout[i]
            a = acts[i]
            z, c = 0.5 * a[:, :h] + 0.5, a[:, h:]
            slope = (1 - np.abs(a)) ** 2
            da[i, :, :h] = dh * (c - hs[i]) * 0.5 * slope[:, :h]
            da[i, :, h:] = dh * z * slope[:, h:]
            du += hs[i].T @ da[i]
            dh = dh * (1 - z) + da[i] @ u.T
        flat, rows = x.ravel(), da.reshape(-1, 2 * h)
        order = np.argsort(flat, kind="stable")
        keys, starts = np.unique(flat[order], return_index=True)
        de = np.zeros_like(self.w[f"E{d}"])
        de[keys] = np.add.reduceat(rows[order], starts, axis=0)
        grads[f"E{d}"], grads[f"U{d}"] = de, du

    def step(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Loss of each window and gradients of a batch: x, mask of shape (time, windows), y the label of each window."""
        af, hf = self._forward(x, "f")
        ab, hb = self._forward(x[::-1], "b")
        of, ob = hf[1:], hb[1:][::-1]
        logits = of @ self.w["Wf"] + ob @ self.w["Wb"] + self.w["b"]
        logits -= logits.max(axis=2, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=2, keepdims=True)
        n = mask.sum()
        picked = np.take_along_axis(p, y[None, :, None], axis=2)[:, :, 0]
        loss = -(np.log(picked + 1e-9) * mask).sum(axis=0) / n
        p[:, np.arange(len(y)), y] -= 1
        p *= (mask / n)[:, :, None]
        grads: dict[str, np.ndarray] = {"b": p.sum(axis=(0, 1))}
        for d, o in (("f", of), ("b", ob)):  # a product for each position: one large product is summed in another order on several threads
            grads[f"W{d}"] = np.matmul(o.transpose(0, 2, 1), p).sum(axis=0)
        self._backward(x, "f", af, hf, p @ self.w["Wf"].T, grads)
        self._backward(x[::-1], "b", ab, hb, (p @ self.w["Wb"].T)[::-1], grads)
        return loss, grads

    def fit(self, lines: list[bytes], labels: np.ndarray, steps: int, seed: int, rate: float = 0.01) -> None:
        """Adam on random windows; languages are drawn evenly at first, then more often the more they are mistaken."""
        rng = np.random.default_rng(seed)
        groups = [np.flatnonzero(labels == k) for k in range(len(LANGUAGES))]
        groups = [g for g in groups if len(g)]
        self.w.pop("calibration", None)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.w.items()}
        hard = np.ones(len(groups))
        for i in range(1, steps + 1):
            drawn = rng.choice(len(groups), size=BATCH, p=0.3 / len(groups) + 0.7 * hard / hard.sum())
            picks = [groups[j][rng.integers(len(groups[j]))] for j in drawn]
            x, mask = np.zeros((WINDOW, BATCH), np.uint8), np.zeros((WINDOW, BATCH), np.float32)
            for j, p in enumerate(picks):
                s = lines[p]
                size = WINDOW if rng.random() < 0.7 else int(rng.integers(8, WINDOW))
                at = int(rng.integers(0, max(1, len(s) - size + 1)))
                part = s[at : at + size]
                x[: len(part), j] = np.frombuffer(part, np.uint8)
                mask[: len(part), j] = 1
            loss, grads = self.step(x, mask, labels[picks])
            loss = loss * mask.sum() / mask.sum(axis=0)
            for j in np.unique(drawn):
                hard[j] = 0.9 * hard[j] + 0.1 * loss[drawn == j].mean()
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            lr = rate * min(1.0, i / 20) * (0.1 + 0.9 * (1 - i / steps))
            for k, g in grads.items():
                g = g * min(1.0, 1.0 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * g
                v2[k] = 0.99 * v2[k] + 0.01 * g * g
                self.w[k] = (self.w[k] - lr * (m[k] / (1 - 0.9**i)) / (np.sqrt(v2[k] / (1 - 0.99**i)) + 1e-8)).astype(np.float32)

    def calibrate(self, held: list[tuple[str, str]]) -> None:
        """Fit the weight and the cost of a change to rows that were not trained on.

        The weight gives held-out lines the greatest likelihood if a label may be wrong; the cost is - log of the share of
        neighbouring lines at which the best paths of the held-out texts change language.
        """
        texts = [([x for x in text.split("\n") if x.strip()], LANGUAGES.index(label)) for text, label in held]
        if not texts:
            return
        evidence = self.evidence([normal_bytes(x) for t, _ in texts for x in t], FEW_ROWS)
        y = np.array([k for t, k in texts for _ in t])
        ends = np.cumsum([len(t) for t, _ in texts])
        likely = []
        for w in WEIGHTS:
            soft = np.exp(w * (evidence - evidence.max(axis=1, keepdims=True)))
            picked = soft[np.arange(len(y)), y] / soft.sum(axis=1)
            likely.append(max(np.log((1 - e) * picked + e / len(LANGUAGES)).sum() for e in (0.01, 0.02, 0.05, 0.1, 0.2)))
        weight, change = WEIGHTS[int(np.argmax(likely))], sum(CHANGES) / 2
        for _ in range(3):
            paths = [best_path(evidence[b - len(t) : b], np.array([plain_length(x) for x in t]), weight, change) for (t, _), b in zip(texts, ends)]
            changes = sum(int((p[1:] != p[:-1]).sum()) for p in paths)
            change = float(np.clip(-np.log((changes + 1) / (len(y) + 1)), *CHANGES))
        self.w["calibration"] = np.array([weight, change], np.float32)
        self.calibration = (float(weight), change)

    # ------------------------------------------------------------ inference
    def evidence(self, lines: list[bytes], rows: int = ROWS) -> np.ndarray:
        """(lines, languages): the sum over all positions of the log-probabilities that the network gives them."""
        out = np.zeros((len(lines), len(LANGUAGES)), np.float32)
        parts = [(i, s[max(0, a - CONTEXT) : a + PART + CONTEXT], min(a, CONTEXT), min(PART, len(s) - a)) for i, s in enumerate(lines) for a in range(0, len(s), PART)]
        parts.sort(key=lambda x: -len(x[1]))
        at = 0
        while at < len(parts):
            longest = len(parts[at][1])
            take = parts[at : at + max(1, min(rows, POSITIONS // longest))]
            np.add.at(out, [i for i, *_ in take], self._block([s for _, s, *_ in take], np.array([a for *_, a, _ in take]), np.array([n for *_, n in take])))
            at += len(take)
        return out

    def _block(self, parts: list[bytes], begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
        lengths = np.array([len(s) for s in parts])  # descending
        t, b, h, k = int(lengths[0]), len(parts), UNITS, len(LANGUAGES)
        x = np.zeros((b, t), np.intp)
        x[np.arange(t)[None, :] < lengths[:, None]] = np.frombuffer(b"".join(parts), np.uint8)
        x = np.ascontiguousarray(x.T)
        active = b - np.searchsorted(lengths[::-1], np.arange(t), side="right")  # lines longer than each position
        scores = np.zeros((t, b, k), np.float32)
        acts, inputs, out = np.empty((2, b, h), np.float32), np.empty((2, b, h), np.float32), np.empty((b, k), np.float32)
        for d in "bf":
            ez, ec = np.ascontiguousarray(self.w[f"E{d}"].reshape(256, 2, h).transpose(1, 0, 2))  # gate and candidate apart, each contiguous
            uz, uc = np.ascontiguousarray(self.w[f"U{d}"].reshape(h, 2, h).transpose(1, 0, 2))
            w = self.w[f"W{d}"]
            state, size = np.zeros((b, h), np.float32), 0
            for i in range(t - 1, -1, -1) if d == "b" else range(t):
                n = int(active[i])
                if n != size:
                    s, a, g, y, size = state[:n], acts[:, :n], inputs[:, :n], out[:n], n
                    z, c, gz, gc = a[0], a[1], g[0], g[1]
                np.matmul(s, uz, out=z)
                np.matmul(s, uc, out=c)
                read = x[i, :n]
                ez.take(read, axis=0, out=gz, mode="clip")
                ec.take(read, axis=0, out=gc, mode="clip")
                a += g
                np.abs(a, out=g)
                g += 1
                a /= g
                z *= 0.5
                z += 0.5
                c -= s
                c *= z
                s += c
                np.matmul(s, w, out=y)
                scores[i, :n] += y
        total, ends = np.zeros((k, b), np.float32), begins + counts
        for i in range(0, t, STRIDE):  # languages before lines, few positions at a time: numpy reduces a last axis of eight slowly
            part = np.ascontiguousarray(scores[i : i + STRIDE].transpose(0, 2, 1))
            part += self.w["b"][:, None]
            part -= part.max(axis=1, keepdims=True)
            part -= np.log(np.exp(part).sum(axis=1, keepdims=True))
            place = np.arange(i, i + len(part))[:, None]
            counted = (place >= begins) & (place < ends)  # context is read but not counted
            if not counted.all():
                part *= counted[:, None, :]
            total += part.sum(axis=0)
        return total.T


def best_path(evidence: np.ndarray, lengths: np.ndarray, weight: float, change: float) -> np.ndarray:
    """The language of each line: Viterbi over the lines of a text, each change of language costs ``change``.

    The path begins and ends in the language that has most evidence over the whole text, so that a first or last line
    needs as much evidence for another language as one between others. ``lengths`` are the lines' plain lengths.
    """
    score = evidence * weight
    score = score - score.max(axis=1, keepdims=True)
    score = np.maximum(score, -2 * FULL * change * np.minimum(1.0, lengths / FULL_LINE)[:, None])
    amount = np.zeros(score.shape[1])
    np.add.at(amount, score.argmax(axis=1), lengths + 1e-3)
    away = np.full(score.shape[1], change)
    away[int(amount.argmax())] = 0
    best, back = score[0] - away, np.zeros(score.shape, np.int64)
    for i in range(1, len(score)):
        top = int(best.argmax())
        changed = best[top] - change
        back[i] = np.where(best >= changed, np.arange(len(best)), top)
        best = np.maximum(best, changed) + score[i]
    path = np.empty(len(score), np.int64)
    path[-1] = int((best - away).argmax())
    for i in range(len(score) - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def training_sample(texts: DataFrame, text: str, label: Column, rows: int = SAMPLE_ROWS) -> list[tuple[str, str]]:
    """(text, label) of at most about ``rows`` labelled rows a language, by a threshold on a hash (two scans, no sort)."""
    known = texts.select(F.col(text).alias("text"), label.alias("label"), F.xxhash64(text).alias("h")).where(F.col("label").isin(*LANGUAGES) & (F.length("text") >= 40))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}  # one row a language
    if not counts:
        return []
    share = F.create_map(*(x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, rows / n)))))
    few = known.where(F.pmod("h", F.lit(1 << 20)) < share[F.col("label")] * (1 << 20))
    return [(r["text"], r["label"]) for r in few.select("text", "label", "h").orderBy("h", "label").collect()]


def train(sample: list[tuple[str, str]], seed: int = 7, steps: tuple[int, int] = STEPS) -> ByteTagger:
    """A tagger fitted to (text, label) rows in two passes; the second leaves out lines that contradict their label.

    One row in HELD_OUT, by its hash, is left out of both passes; copies of a text fall on the same side.
    """
    rng = np.random.default_rng(seed)
    lines, labels, held = [], [], []
    for text, label in sample:
        if int(hashlib.md5(text.encode("utf-8", errors="replace")).hexdigest()[:8], 16) % HELD_OUT == 0:
            held.append((text, label))
            continue
        own = [x for x in text.split("\n") if len(x.strip()) >= 8]
        for i in sorted(rng.permutation(len(own))[:SAMPLE_LINES]):
            lines.append(normal_bytes(own[i]))
            labels.append(LANGUAGES.index(label))
    tagger, y = ByteTagger(seed=seed), np.array(labels, np.int64)
    if not lines:
        return tagger
    tagger.fit(lines, y, steps[0], seed)
    evidence = tagger.evidence(lines, FEW_ROWS)
    margin = (evidence.max(axis=1) - evidence[np.arange(len(y)), y]) / np.array([len(s) for s in lines])
    keep = margin <= 0
    for k in range(len(LANGUAGES)):  # of each label, only its most contradictory lines go: else a weak first pass drops what is hard
        own = np.flatnonzero(y == k)
        keep[own[np.argsort(margin[own], kind="stable")][: int(np.ceil((1 - WRONG_LABELS) * len(own)))]] = True
    tagger.fit([s for s, ok in zip(lines, keep) if ok], y[keep], steps[1], seed + 1, 0.008)
    tagger.calibrate(held)
    return tagger


def trained(spark: SparkSession, sample: list[tuple[str, str]]) -> ByteTagger:
    """The tagger of a sample: read from the shared folder if it was trained before, else trained and kept there."""
    told = hashlib.md5(repr((VERSION, UNITS, WINDOW, BATCH, STEPS, SAMPLE_LINES, HELD_OUT, WRONG_LABELS, sample)).encode("utf-8", errors="replace")).hexdigest()
    path = shared_dir(spark, f"language-{told}", new=False)
    if not finished(spark, path):
        weights = train(sample).w
        rows = [(k, list(v.shape), [float(x) for x in v.ravel()]) for k, v in weights.items()]
        spark.createDataFrame(rows, "name string, shape array<int>, weights array<float>").coalesce(1).write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path).collect()  # the network's seven tables and its calibration
    return ByteTagger({r["name"]: np.array(r["weights"], np.float32).reshape(r["shape"]) for r in rows})


def label_text(lines: list[str], evidence: np.ndarray, weight: float, change: float) -> tuple[str, float, list[tuple[int, str, float]]]:
    """Language and confidence of a text, and of each of its non-blank lines, from the lines' evidence."""
    numbers = [i for i, x in enumerate(lines) if x.strip()]
    sizes = np.array([len(lines[i].strip()) for i in numbers])
    score = evidence * weight
    score -= score.max(axis=1, keepdims=True)
    path = score.argmax(axis=1)
    if (path != path[0]).any() or len(path) > ALIKE or not any(has_words(lines[i]) for i in numbers):  # else no path is better than the one that never changes
        path = best_path(evidence, np.array([plain_length(lines[i]) for i in numbers]), weight, change)
    soft = np.exp(np.maximum(score, -30))
    soft /= soft.sum(axis=1, keepdims=True)
    amount = np.zeros(len(LANGUAGES))
    np.add.at(amount, path, sizes)
    main = int(amount.argmax())
    confidence = float((soft[:, main] * sizes).sum() / sizes.sum())
    return LANGUAGES[main], confidence, [(n, LANGUAGES[k], float(soft[j, k])) for j, (n, k) in enumerate(zip(numbers, path))]


_RESULT = pa.struct([("seg_no", pa.int32()), ("lang", pa.string()), ("confidence", pa.float64())])


def _labels(weights: dict[str, np.ndarray], keys: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = ByteTagger(weights)
        for whole in batches:
            for a in range(0, whole.num_rows, 2000):
                batch = whole.slice(a, 2000)
                texts = [x.split("\n") for x in batch.column(keys).to_pylist()]
                spoken = [[x for x in t if x.strip()] for t in texts]
                numbers: dict[str, int] = {}
                at_line = [numbers.setdefault(x, len(numbers)) for t in spoken for x in t]
                evidence = tagger.evidence([normal_bytes(x) for x in numbers])[at_line]  # a line that recurs is read once
                langs, sure, segments, at = [], [], [], 0
                for t, s in zip(texts, spoken):
                    lang, confidence, lines = label_text(t, evidence[at : at + len(s)], *tagger.calibration) if s else (None, 0.0, [])
                    at += len(s)
                    langs.append(lang), sure.append(confidence), segments.append([{"seg_no": n, "lang": k, "confidence": c} for n, k, c in lines])
                yield pa.RecordBatch.from_arrays([*batch.columns[:keys], pa.array(langs, pa.string()), pa.array(sure, pa.float64()), pa.array(segments, pa.list_(_RESULT))], names=[*batch.schema.names[:keys], "lang", "confidence", "segments"])

    return run


def label_languages(texts: DataFrame, tagger: ByteTagger, text: str, keys: list[str]) -> DataFrame:
    """(keys..., lang, confidence, segments): the language of every non-NULL text and of each of its non-blank lines."""
    rows = spread(texts.where(F.col(text).isNotNull()).select(*keys, F.col(text).alias("_text")))
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", lang string, confidence double, segments array<struct<seg_no:int,lang:string,confidence:double>>"
    return rows.mapInArrow(_labels(tagger.w, len(keys)), schema)


def label_code(label: Column) -> Column:
    """A label's language: lower case without country; NULL for empty and undetermined labels."""
    code = F.lower(F.regexp_extract(F.trim(label), r"^([A-Za-z]{2,3})(?:[\-_].*)?$", 1))
    code = F.when(code == "fil", "tl").when(code == "in", "id").otherwise(code)
    return F.when(code.isNull() | code.isin("", "und"), F.lit(None)).otherwise(code)


def find_mislabelled(labelled: DataFrame) -> DataFrame:
    """(rec_type, rec_id, seg_no, lang) from rows with ``label``: texts of missing or wrong label as seg_no -1, and every line of mixed texts.

    An event with several summaries gives the rows of each of them, equal ones once.
    """
    known = labelled.where("lang is not null")
    wrong = known.where(~F.coalesce(F.col("label") == F.col("lang"), F.lit(False))).select("rec_type", "rec_id", F.lit(-1).alias("seg_no"), "lang")
    mixed = known.where(F.size(F.array_distinct(F.transform("segments", lambda s: s["lang"]))) > 1).select("rec_type", "rec_id", F.explode("segments").alias("s"))
    return wrong.unionByName(mixed.select("rec_type", "rec_id", F.col("s.seg_no").alias("seg_no"), F.col("s.lang").alias("lang"))).distinct()
