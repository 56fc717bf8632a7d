"""Languages of documents and of the segments of mixed ones, with confidences.

One interpolated Kneser-Ney character model per language, over words padded by a boundary: the
probability of a character given up to four before it in its word. The n-grams of all languages
share one sorted array of 64-bit hashes per order, whose rows hold the log-probability in every
language, so one binary search serves all languages.

A text gets the language of the lowest cross-entropy per character. Texts whose cross-entropy is
above what held-out texts of that language reach, or that hold no letters, are rejected (``und``).
Confidences are softmax values at a temperature fitted to held-out texts.

Words are scored once per worker and remembered, so a long corpus costs a dictionary look-up and
a row sum per word. A text is cut at sentence ends and separators; where its parts disagree, or
one part is better explained by two languages, the best sequence of languages is found with a
price for every change.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataline.llm.skeleton import plain

ORDER = 5
#: Price, in nats, of a change of language at a separator and within a part.
SWITCH, SWITCH_INSIDE = 9.0, 14.0
#: Segments of fewer letters than this don't stand alone.
LEAST_LETTERS = 24
#: Words a worker remembers before it starts anew; bounds memory, never results.
REMEMBERED = 300_000
#: Training sample: texts per language and characters of each.
SAMPLE_TEXTS, SAMPLE_CHARS = 300, 1_500
_EAST = "\u3005\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uac00-\ud7a3"
_TOKEN = re.compile(rf"[^\W_{_EAST}]+(?:['’][^\W\d_{_EAST}]+)*|[{_EAST}]+|[.!?;:。！？；\[\]\n\x00]|\s?[-–—/=|]+\s?")
_EASTERN = re.compile(f"[{_EAST}]")
#: Characters that are neither disguised nor part of a disguise, as far as languages go.
_USUAL = re.compile(rf"[\x00-\x7f\u00a1-\u00ac\u00ae-\u024f\u2013-\u2026\u3001-\u303f，：；（）{_EAST}]*")
_TAGS = re.compile(r"<[^<>]{1,40}>|\[\d{4}\]")
#: Number of the token that opens a text; separators have -1, tokens of no language 0.
OPENS = -2
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _hashes(codes: np.ndarray, position: np.ndarray) -> list[np.ndarray]:
    """Per order k: hashes of the k characters that end at each place (0 where a word is too short)."""
    out = [np.zeros(len(codes), np.uint64)]
    for k in range(1, ORDER + 1):
        before = np.zeros(len(codes), np.uint64)
        before[1:] = out[k - 1][:-1]
        h = (before + np.uint64(k)) * _BASE + codes
        h ^= h >> np.uint64(29)
        out.append(np.where(position >= k - 1, h, np.uint64(0)))
    return out


def _padded(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Character codes of all words, each between two boundaries, places in the word, and word lengths."""
    text = "".join(["\x02" + w + "\x03" for w in words])
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.array([len(w) + 2 for w in words])
    position = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return codes, position, lengths


@dataclass
class Model:
    """Log-probabilities of n-grams and log-weights of contexts, per order, in all languages."""

    langs: list[str]
    keys: list[np.ndarray] = field(default_factory=list)
    probs: list[np.ndarray] = field(default_factory=list)
    context_keys: list[np.ndarray] = field(default_factory=list)
    weights: list[np.ndarray] = field(default_factory=list)
    temperature: float = 1.0
    #: Per language: the cross-entropy above which a text is rejected.
    most: np.ndarray | None = None
    floor: float = -11.0

    def score(self, words: list[str]) -> np.ndarray:
        """(words, languages) log-probabilities."""
        codes, position, lengths = _padded(words)
        hashes = _hashes(codes, position)
        total = np.zeros((len(codes), len(self.langs)), np.float32)
        open_ = position > 0
        done = ~open_
        for k in range(ORDER, 0, -1):
            todo = np.flatnonzero(~done & (position >= k - 1))
            if not len(todo):
                continue
            h = hashes[k][todo]
            at = np.minimum(np.searchsorted(self.keys[k], h), len(self.keys[k]) - 1)
            found = self.keys[k][at] == h
            hit = todo[found]
            total[hit] += self.probs[k][at[found]]
            done[hit] = True
            miss = todo[~found]
            if k > 1 and len(miss):
                c = hashes[k - 1][miss - 1]
                keys = self.context_keys[k]
                at = np.minimum(np.searchsorted(keys, c), len(keys) - 1)
                known = keys[at] == c
                total[miss[known]] += self.weights[k][at[known]]
        total[~done] += self.floor
        starts = np.cumsum(lengths) - lengths
        return np.add.reduceat(total, starts, axis=0) if len(words) else np.zeros((0, len(self.langs)), np.float32)


def train(counts: dict[str, dict[str, int]]) -> Model:
    """A model of the words of each language with their counts."""
    langs = sorted(counts)
    n_langs = len(langs)
    seen: list[list] = [[] for _ in range(ORDER + 1)]
    for lang in langs:
        words = sorted(counts[lang])
        codes, position, lengths = _padded(words)
        weight = np.repeat(np.array([counts[lang][w] for w in words], np.float64), lengths)
        hashes = _hashes(codes, position)
        continued: tuple[np.ndarray, np.ndarray] | None = None
        for k in range(ORDER, 0, -1):
            ok = np.flatnonzero((position >= k - 1) & (position > 0))
            # N-grams that begin a word are counted as they are, all others of lower order by
            # the different characters before them.
            key, first, inverse = np.unique(hashes[k][ok], return_index=True, return_inverse=True)
            raw = np.bincount(inverse, weight[ok], len(key))
            opens = position[ok][first] == k - 1
            count = raw
            if k < ORDER and continued is not None:
                at = np.minimum(np.searchsorted(continued[0], key), max(0, len(continued[0]) - 1))
                different = np.where(continued[0][at] == key, continued[1][at], 0.0) if len(continued[0]) else np.zeros(len(key))
                count = np.where(opens, raw, np.maximum(different, 1.0))
            context = hashes[k - 1][ok[first] - 1] if k > 1 else np.zeros(len(key), np.uint64)
            suffix = hashes[k - 1][ok[first]] if k > 1 else np.zeros(len(key), np.uint64)
            if k > 1:
                lower, n = np.unique(suffix, return_counts=True)
                continued = (lower, n.astype(np.float64))
            ones, twos = float((count == 1).sum()), float((count == 2).sum())
            discount = min(0.95, max(0.3, ones / (ones + 2 * twos))) if ones else 0.5
            seen[k].append((key, count, context, suffix, discount))
    model = Model(langs)
    model.keys, model.probs, model.context_keys, model.weights = ([None] * (ORDER + 1) for _ in range(4))
    letters = max(2, len({c for words in counts.values() for w in words for c in w}))
    model.floor = float(-np.log(letters * 8))
    below = None
    for k in range(1, ORDER + 1):
        keys = np.unique(np.concatenate([s[0] for s in seen[k]])) if seen[k] else np.zeros(0, np.uint64)
        contexts = np.unique(np.concatenate([s[2] for s in seen[k]])) if seen[k] else np.zeros(0, np.uint64)
        context_of, suffix_of = np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.uint64)
        counted, share = np.zeros((len(keys), n_langs)), np.ones((len(contexts), n_langs))
        for j, (key, count, context, suffix, discount) in enumerate(seen[k]):
            at = np.searchsorted(keys, key)
            context_of[at], suffix_of[at] = context, suffix
            own, inverse = np.unique(context, return_inverse=True)
            total = np.bincount(inverse, count, len(own))
            kinds = np.bincount(inverse, minlength=len(own))
            counted[at, j] = np.maximum(count - discount, 0.0) / total[inverse]
            share[np.searchsorted(contexts, own), j] = discount * kinds / total
        weight = share[np.searchsorted(contexts, context_of)]
        lower = np.full((len(keys), n_langs), np.exp(model.floor)) if k == 1 else below[1][np.searchsorted(below[0], suffix_of)]
        probability = counted + weight * lower
        below = (keys, probability)
        model.keys[k] = keys
        model.probs[k] = np.log(probability).astype(np.float32)
        model.context_keys[k], model.weights[k] = contexts, np.log(share).astype(np.float32)
    return model


def _neutral(token: str) -> bool:
    """Symbols, acronyms and numbers are of no language."""
    return any(c.isdigit() for c in token) or any(c.isupper() for c in token[1:])


def _separates(token: str) -> bool:
    """Whether a token of marks ends a part: sentence ends and brackets do, strokes between blanks do."""
    return token in ".!?;:。！？；[]\n\x00" or (token[0].isspace() and token[-1].isspace())


def readable(text: str) -> str:
    """``text`` in its plain form, without mark-up, and in lower case where all of it is upper case."""
    if not text.isascii() and not _USUAL.fullmatch(text):
        text = plain(text)
    if "<" in text or "[0" in text:
        text = _TAGS.sub(lambda m: " " * len(m.group()), text)
    return text.lower() if text.isupper() and not _EASTERN.search(text) else text


def stored_position(text: str, at: int) -> int:
    """The place in ``text`` of the place ``at`` of its readable form: behind the longest beginning that isn't longer."""
    low, high = 0, len(text)
    while low < high:
        middle = (low + high + 1) // 2
        if len(readable(text[:middle])) <= at:
            low = middle
        else:
            high = middle - 1
    return low


def _stored(text: str, form: str, segments: list[tuple[str, float, int, int]]) -> list[tuple[str, float, int, int]]:
    """Segments of the readable ``form`` with the positions of ``text``."""
    if len(form) == len(text):
        return segments
    inner = [stored_position(text, s[2]) for s in segments[1:]]
    return [(lang, sure, a, b) for (lang, sure, _, _), a, b in zip(segments, [0, *inner], [*inner, len(text)])]


class Identifier:
    """Assigns languages with one model; one per worker."""

    def __init__(self, model: Model):
        self.model = model
        self.langs = [*model.langs, "und"]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        # Row 0 is that of tokens without a language.
        self.rows = np.zeros((1, len(self.model.langs)), np.float32)
        self.top = np.zeros(1, np.float32)
        self.letters = np.zeros(1, np.int64)

    def learn(self, tokens: set[str]) -> None:
        words = []
        for t in tokens:
            if t == "\x00":
                self.known[t] = OPENS
            elif not t[-1].isalnum() and not t[0].isalnum():
                self.known[t] = -1 if _separates(t) else 0
            elif _neutral(t):
                self.known[t] = 0
            else:
                words.append(t)
        if words:
            low = [w.lower() for w in words]
            base = len(self.rows)
            scored = self.model.score(low)
            self.rows = np.concatenate([self.rows, scored])
            self.top = np.concatenate([self.top, scored.max(axis=1)])
            self.letters = np.concatenate([self.letters, np.array([len(w) + 1 for w in low])])
            self.known.update(zip(words, range(base, base + len(words))))

    def identify(self, texts: list[str]) -> list[list[tuple[str, float, int, int]]]:
        """Per readable text its segments: language, confidence, start and end."""
        if not texts:
            return []
        if len(self.known) > REMEMBERED:
            self.forget()
        # All texts at once, each opened by a mark of its own.
        tokens = _TOKEN.findall("\x00" + "\x00".join([t.replace("\x00", " ") for t in texts]))
        known = self.known
        if new := set(tokens).difference(known):
            self.learn(new)
        flat = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
        starts = np.flatnonzero(flat == OPENS)
        ends = np.append(starts[1:], len(tokens))
        ids = np.maximum(flat, 0)
        scores, letters = self.rows[ids], self.letters[ids]
        # Parts: runs of tokens between separators; every text begins one.
        part_at = np.flatnonzero(flat < 0)
        part_score = np.add.reduceat(scores, part_at, axis=0)
        part_letters = np.add.reduceat(letters, part_at)
        slack = np.add.reduceat(self.top[ids], part_at) - part_score.max(axis=1)
        part_best = part_score.argmax(axis=1)
        first_part = np.searchsorted(part_at, starts)
        total = np.add.reduceat(part_score, first_part, axis=0)
        size = np.add.reduceat(part_letters, first_part)
        held = part_letters > 0
        low = np.minimum.reduceat(np.where(held, part_best, 1 << 20), first_part)
        high = np.maximum.reduceat(np.where(held, part_best, -1), first_part)
        strained = np.maximum.reduceat(slack, first_part) >= SWITCH_INSIDE
        best = total.argmax(axis=1)
        gap = np.exp((total - total[np.arange(len(total)), best][:, None]) * self.model.temperature)
        confidence = np.round(1.0 / gap.sum(axis=1).astype(np.float64), 4)
        entropy = -total[np.arange(len(total)), best] / np.maximum(size, 1)
        refused = (entropy > self.model.most[best]) if self.model.most is not None else np.zeros(len(best), bool)
        out: list[list[tuple[str, float, int, int]]] = []
        rows = zip(texts, best.tolist(), confidence.tolist(), refused.tolist(), size.tolist(), ((low == high) & ~strained).tolist())
        for i, (text, lang, sure, no, n, simple) in enumerate(rows):
            if not n:
                out.append([("und", 0.0, 0, len(text))])
            elif simple:
                out.append([("und" if no else self.langs[lang], sure, 0, len(text))])
            else:
                s, e = int(starts[i]) + 1, int(ends[i])
                out.append(self._segments(text, scores[s:e], letters[s:e], flat[s:e] < 0))
        return out

    def _judge(self, score: np.ndarray, letters: int) -> tuple[str, float]:
        best = int(score.argmax())
        p = np.exp((score - score[best]) * self.model.temperature)
        rejected = self.model.most is not None and -score[best] / letters > self.model.most[best]
        return ("und" if rejected else self.langs[best]), round(float(1.0 / p.sum()), 4)

    def _segments(self, text: str, scores: np.ndarray, letters: np.ndarray, begins: np.ndarray) -> list[tuple[str, float, int, int]]:
        path = self._path(scores, begins)
        if path.count(path[0]) == len(path):
            lang, confidence = self._judge(scores.sum(axis=0), max(1, int(letters.sum())))
            return [(lang, confidence, 0, len(text))]
        # Merge runs; those of too few letters join the longer neighbour.
        runs: list[list[int]] = []
        for i, lang in enumerate(path):
            if runs and runs[-1][2] == lang:
                runs[-1][1] = i + 1
            else:
                runs.append([i, i + 1, lang])
        while len(runs) > 1:
            size = [int(letters[a:b].sum()) for a, b, _ in runs]
            j = min(range(len(runs)), key=lambda j: size[j])
            if size[j] >= self._least(runs[j][2]):
                break
            near = max((k for k in (j - 1, j + 1) if 0 <= k < len(runs)), key=lambda k: size[k])
            runs[j][2] = runs[near][2]
            merged: list[list[int]] = []
            for r in runs:
                if merged and merged[-1][2] == r[2]:
                    merged[-1][1] = r[1]
                else:
                    merged.append(r)
            runs = merged
        spans = [m.span() for m in _TOKEN.finditer(text)]
        # A segment begins with its first word; what separates it belongs to the one before.
        for n, r in enumerate(runs[1:], 1):
            while r[0] < r[1] - 1 and begins[r[0]]:
                r[0] += 1
            runs[n - 1][1] = r[0]
        out: list[tuple[str, float, int, int]] = []
        for n, (a, b, _) in enumerate(runs):
            lang, confidence = self._judge(scores[a:b].sum(axis=0), max(1, int(letters[a:b].sum())))
            start = 0 if n == 0 else spans[a][0]
            end = len(text) if n == len(runs) - 1 else spans[runs[n + 1][0]][0]
            if out and out[-1][0] == lang:
                out[-1] = (lang, max(out[-1][1], confidence), out[-1][2], end)
            else:
                out.append((lang, confidence, start, end))
        return out

    def _least(self, lang: int) -> int:
        return 8 if self.langs[lang] in ("zh", "ja", "ko") else LEAST_LETTERS

    def _path(self, scores: np.ndarray, begins: np.ndarray) -> list[int]:
        """The sequence of languages of least cost: each word's score and a price per change."""
        base = int(scores.sum(axis=0).argmax())
        n = len(scores)
        # A language is worth a change only if on some span it gains the price over the whole
        # text's language; the greatest gain of any span is a running difference of sums.
        gains = np.zeros((n + 1, scores.shape[1]))
        np.cumsum(scores - scores[:, base : base + 1], axis=0, out=gains[1:])
        most = (gains - np.minimum.accumulate(gains, axis=0)).max(axis=0)
        langs = [base, *[int(i) for i in np.flatnonzero(most >= SWITCH) if i != base]]
        if len(langs) == 1:
            return [base] * n
        rows = scores[:, langs].tolist()
        best, back = rows[0], []
        for row, begin in zip(rows[1:], begins[1:].tolist()):
            top = max(best)
            changed, source = top - (SWITCH if begin else SWITCH_INSIDE), best.index(top)
            back.append([k if b >= changed else source for k, b in enumerate(best)])
            best = [(b if b >= changed else changed) + r for b, r in zip(best, row)]
        at = best.index(max(best))
        path = [at]
        for step in reversed(back):
            at = step[at]
            path.append(at)
        return [langs[k] for k in reversed(path)]


def training_sample(df: DataFrame, text: str, lang: str, key: str, texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """``lang`` and ``text`` of at most ``texts`` labelled texts per language, the same on every run.

    The smallest hashes of ``key`` win; each partition keeps no more than that many per language
    before anything is shuffled.
    """
    label, body = F.lower(F.trim(F.col(f"`{lang}`"))), F.col(f"`{text}`")
    rows = df.select(label.alias("lang"), F.substring(body, 1, chars).alias("text"), F.xxhash64(f"`{key}`").alias("h")).where("lang <> '' AND length(text) >= 40")
    return rows.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy("h", "text"))).where(F.col("rank") <= texts).select("lang", "text", "rank")


def _rejection(counts: dict[str, dict[str, int]], model: Model) -> np.ndarray:
    """Per language the cross-entropy that its own new words hardly ever exceed.

    Held-out texts share most words with the training texts and would say too little about texts
    of another kind. So a second model is trained without every other word, and the threshold is
    the 98th percentile of the words it hasn't seen (of all languages', where there are few). A
    language of unspaced words has the threshold of a text in which nine of ten characters are new.
    """
    order = {lang: sorted(words) for lang, words in counts.items()}
    half = train({lang: {w: counts[lang][w] for w in words[::2]} for lang, words in order.items()})
    found = []
    for i, lang in enumerate(half.langs):
        new = [w for w in order[lang][1::2] if len(w) > 3]
        found.append(-half.score(new)[:, i] / np.array([len(w) + 1 for w in new]) if new else np.zeros(0))
    spaced = [not any(map(_EASTERN.search, order[lang][:100])) for lang in half.langs]
    pool = np.concatenate([f for f, ok in zip(found, spaced) if ok] or [np.zeros(0)])
    common = float(np.quantile(pool, 0.98)) if len(pool) else -0.9 * model.floor
    return np.array([(float(np.quantile(f, 0.98)) if len(f) >= 100 else common) if ok else -0.9 * model.floor for f, ok in zip(found, spaced)])


def fit(sample: list[tuple[str, str, int]]) -> Model:
    """A model of a bounded sample of ``(lang, text, rank)``; every fifth text is held out to calibrate."""
    counts: dict[str, dict[str, int]] = {}
    held: list[tuple[str, str]] = []
    for lang, text, rank in sorted(sample, key=lambda r: (r[0], r[2], r[1])):
        if rank % 5 == 0:
            held.append((lang, text))
            continue
        own = counts.setdefault(lang, {})
        for token in _TOKEN.findall(readable(text)):
            if token[0].isalnum() and not _neutral(token):
                token = token.lower()
                own[token] = own.get(token, 0) + 1
    counts = {lang: words for lang, words in counts.items() if words}
    model = train(counts)
    identifier = Identifier(model)
    at = {lang: i for i, lang in enumerate(model.langs)}
    totals, lengths, truth = [], [], []
    for lang, text in held:
        if lang not in at:
            continue
        tokens = [t for t in _TOKEN.findall(readable(text)) if t[0].isalnum()]
        identifier.learn({t for t in tokens if t not in identifier.known})
        ids = np.array([max(0, identifier.known[t]) for t in tokens], np.int64)
        n = int(identifier.letters[ids].sum())
        if n:
            totals.append(identifier.rows[ids].sum(axis=0))
            lengths.append(n)
            truth.append(at[lang])
    if totals:
        score, size, true = np.array(totals, np.float64), np.array(lengths), np.array(truth)

        def loss(t: float) -> float:
            z = score * t
            z -= z.max(axis=1, keepdims=True)
            return float(-(z[np.arange(len(z)), true] - np.log(np.exp(z).sum(axis=1))).mean())

        model.temperature = min((0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 1.0), key=loss)
    model.most = _rejection(counts, model)
    return model


#: The identifier that a worker holds, by the name of its model.
_IDENTIFIERS: dict[str, Identifier] = {}

SEGMENTS = "array<struct<lang:string,confidence:double,start_pos:int,end_pos:int>>"


def identified(df: DataFrame, keys: list[str], texts: dict[str, str], model: Model) -> DataFrame:
    """``keys``, ``field``, ``label``, ``segments`` of each text column in ``texts`` (column to label column).

    A null text has no row; an empty or blank one, and one without letters, has one segment
    ``und`` of confidence 0. Segments are in order and cover the text; positions count code
    points of the text as it stands, which is read in its plain form.
    """
    shared, name = df.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    cells = F.inline(F.array(*[F.struct(F.lit(t).alias("field"), F.col(f"`{label}`").alias("label"), F.col(f"`{t}`").alias("text")) for t, label in texts.items()]))
    source = df.select(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)], cells).where("text IS NOT NULL")
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _IDENTIFIERS:
            _IDENTIFIERS.clear()
            _IDENTIFIERS[name] = Identifier(shared.value)
        identifier = _IDENTIFIERS[name]
        kind = pa.list_(pa.struct([("lang", pa.string()), ("confidence", pa.float64()), ("start_pos", pa.int32()), ("end_pos", pa.int32())]))
        for batch in batches:
            texts = batch.column(n + 2).to_pylist()
            forms = [readable(t) for t in texts]
            found = [_stored(*x) for x in zip(texts, forms, identifier.identify(forms))]
            flat = [s for own in found for s in own]
            struct = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(zip(*flat), [f.type for f in kind.value_type])], fields=list(kind.value_type)) if flat else pa.array([], kind.value_type)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(o) for o in found])]).astype(np.int32)), struct)
            yield pa.RecordBatch.from_arrays([*batch.columns[: n + 2], lists], names=[*batch.schema.names[: n + 2], "segments"])

    head = ", ".join(f"k{i} {source.schema[i].dataType.simpleString()}" for i in range(n))
    out = source.mapInArrow(run, f"{head}, field string, label string, segments {SEGMENTS}")
    return out.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], "field", "label", "segments")


def languages(segments: Column) -> Column:
    """The different languages of a text's segments, rejected ones left out."""
    return F.array_distinct(F.filter(F.transform(segments, lambda s: s["lang"]), lambda x: x != "und"))
