"""Licence notices by a trained paragraph classifier, in DataFrame expressions.

A paragraph is a line, or a block: a run of two or more lines that hold a
letter or digit, joined, as a notice wrapped at some width is (comment marks
are no words; a line of nothing else ends a block). Paragraphs become word uni-
and bigrams. A sparse multinomial logistic
regression, one class for each licence family and one for all other text, is
fitted to variants of the families' notices and to a bounded sample of corpus
paragraphs (``SAMPLE_DOCS`` documents, those with the smallest hash of their
id, and at most ``SAMPLE_PARAGRAPHS`` of their paragraphs). Its weights are few
enough to be literals of the scoring expression's broadcast table.

The unknown class is calibrated: a temperature fitted on held-out examples
scales the scores, and a paragraph is of a family only if that one's
probability is above what ``QUANTILE`` of the held-out corpus paragraphs reach,
and above one half. A predicted family is confirmed if enough of one of its
notices' bigrams occur in the paragraph.

A block has the number of its first line. It is of its best family, and of each
other one that is likelier than the unknown class by the same threshold and
confirmed by bigrams that the best one's notices don't have. Each family of a
block is told once: by the lines that confirm it, else by the block if that
confirms it, else by the lines that are predicted, else by the block.

Scoring looks at every paragraph of every text: one that holds none of the
n-grams that speak for a family cannot score above the unknown class, and each
such n-gram holds a word of a short list, so the words are looked up first.

Edge cases: null and empty texts have no paragraphs and no rows; paragraph
numbers count all lines from 0, blank ones too; repeated rows are scored each for itself; an
empty table gives an empty result (the classifier is then fitted to notices
alone); other columns of the input play no part.
"""

from __future__ import annotations

import math
import random
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The wording by which common licences are announced.
NOTICES = {
    "Apache": (
        "licensed under the apache license version 2.0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at http www.apache.org licenses license 2.0",
        "released under the apache software license",
        "spdx license identifier apache 2.0",
    ),
    "BSD": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "licensed under the bsd 3 clause license",
        "use of this source code is governed by a bsd style license that can be found in the license file",
        "spdx license identifier bsd 3 clause",
    ),
    "CC": (
        "this work is licensed under a creative commons attribution 4.0 international license",
        "licensed under cc by nc 4.0",
        "licensed under cc by sa 3.0",
        "content is available under the creative commons attribution sharealike license",
    ),
    "GPL": (
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
        "licensed under the gnu lesser general public license version 2.1",
        "spdx license identifier gpl 3.0 or later",
    ),
    "MIT": (
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
        "licensed under the mit license see license file in the project root",
        "spdx license identifier mit",
    ),
    "MPL": (
        "this source code form is subject to the terms of the mozilla public license v 2.0",
        "licensed under the mozilla public license version 2.0",
        "spdx license identifier mpl 2.0",
    ),
}
UNKNOWN = "unknown"

#: Bounds of the fit's sample: documents, paragraphs, and words of a paragraph.
SAMPLE_DOCS, SAMPLE_PARAGRAPHS, SAMPLE_WORDS = 400, 4000, 2000
VARIANTS = 40
#: N-grams of corpus paragraphs that occur in more than this share of them say nothing.
COMMON = 0.005
EPOCHS, RATE, SPARSITY = 30, 0.5, 2e-4
SHARE = 0.6
#: The share of held-out corpus paragraphs that stay below the threshold: one odd paragraph doesn't set it.
QUANTILE = 0.99


def _let(value: F.Column, fn) -> F.Column:
    """``fn(value)``. A lambda's argument is a value, so it is computed once for a row."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def _literal(words: list[str]) -> F.Column:
    return F.array(*[F.lit(w) for w in words])


def _split(text: F.Column) -> F.Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.split(F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), " ")


def _blocks(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, start, lines): runs of lines that hold a letter or digit."""

    def runs(lines: F.Column) -> F.Column:
        def of(filled: F.Column) -> F.Column:
            edge = lambda step: F.filter(
                F.sequence(F.lit(0), F.size(filled) - 1), lambda i: F.get(filled, i) & ~F.coalesce(F.get(filled, i + step), F.lit(False))
            )
            return F.zip_with(edge(-1), edge(1), lambda i, j: F.struct(i.alias("start"), F.slice(lines, i + 1, j - i + 1).alias("lines")))

        return _let(F.transform(lines, lambda x: x.rlike(r"[\p{L}\p{N}]")), of)

    return docs.select(F.col(doc_id).alias("doc_id"), F.explode(_let(F.split(F.col(text).cast("string"), "\n"), runs)).alias("block")).select("doc_id", "block.*")


def _units(block: F.Column, lines: F.Column, start: F.Column) -> F.Column:
    """The paragraphs of a block of these words: its lines, and itself if it has several."""
    unit = lambda number, joined, words: F.struct(number.alias("paragraph"), joined.alias("joined"), words.alias("words"))
    each = F.transform(lines, lambda x, i: unit(start + i, F.lit(False), _split(x)))
    return F.when(F.size(lines) > 1, F.concat(each, F.array(unit(start, F.lit(True), block)))).otherwise(each)


def _grams(words: F.Column) -> F.Column:
    """Distinct words and pairs of neighbours."""
    pairs = lambda w: F.slice(F.transform(w, lambda x, i: F.concat(x, F.lit(" "), F.get(w, i + 1))), F.lit(1), F.size(w) - 1)
    return _let(words, lambda w: F.array_distinct(F.concat(w, F.when(F.size(w) > 1, pairs(w)).otherwise(F.slice(w, 1, 0)))))


def _known(family: str) -> list[list[str]]:
    """The bigrams of each of a family's notices."""
    return [sorted({f"{a} {b}" for a, b in zip(n, n[1:])}) for n in map(_words, NOTICES[family])]


def _share(grams: F.Column, family: str) -> F.Column:
    return F.greatest(*[F.size(F.array_intersect(grams, _literal(b))) / F.lit(float(len(b))) for b in _known(family)])


def grams_of(words: list[str]) -> set[str]:
    return {*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))}


def _words(notice: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in notice.lower()).split()


def share_of(bigrams: set[str], words: list[str]) -> float:
    own = {f"{a} {b}" for a, b in zip(words, words[1:])}
    return len(own & bigrams) / len(bigrams)


class Model:
    """Weights by family and n-gram, biases, temperature and threshold."""

    def __init__(self, corpus: list[list[str]], seed: int = 5):
        rng = random.Random(seed)
        families = [*NOTICES, UNKNOWN]
        notices = {f: [_words(n) for n in NOTICES[f]] for f in NOTICES}
        known = {f: [{f"{a} {b}" for a, b in zip(n, n[1:])} for n in notices[f]] for f in NOTICES}
        examples: list[tuple[set[str], int]] = []
        filler = [w for p in corpus for w in p][:20_000] or ["text"]
        for k, f in enumerate(NOTICES):
            for notice in notices[f]:
                for v in range(VARIANTS):  # words dropped, and prose around
                    words = [w for w in notice if v == 0 or rng.random() > 0.08]
                    around = rng.randrange(0, 12) if v else 0
                    words = [rng.choice(filler) for _ in range(around // 2)] + words + [rng.choice(filler) for _ in range(around - around // 2)]
                    examples.append((grams_of(words), k))
        for words in corpus:  # a notice among the sample is an example of its family
            k = next((k for k, f in enumerate(NOTICES) if any(share_of(b, words) >= SHARE for b in known[f])), len(NOTICES))
            examples.append((grams_of(words), k))
        frequency = Counter(g for x, k in examples if k == len(NOTICES) for g in x)
        n_unknown = max(1, sum(k == len(NOTICES) for _, k in examples))
        wanted = {g for f in NOTICES for n in notices[f] for g in grams_of(n)}
        self.vocabulary = sorted(g for g in wanted if frequency[g] <= COMMON * n_unknown)
        self.families = families
        rng.shuffle(examples)
        index = {g: i for i, g in enumerate(self.vocabulary)}
        coded = [(sorted(index[g] for g in x if g in index), k) for x, k in examples]
        held = coded[::5]
        self._fit([c for i, c in enumerate(coded) if i % 5], len(families))
        self._calibrate(held)
        # The rarest word of each n-gram that speaks for a family.
        self.cues = sorted({min(g.split(" "), key=lambda w: (frequency[w], w)) for i, g in enumerate(self.vocabulary) if any(self.weights[k][i] > self.weights[-1][i] for k in range(len(families) - 1))})

    def _scores(self, x: list[int]) -> list[float]:
        return [b + sum(w[i] for i in x) for b, w in zip(self.bias, self.weights)]

    @staticmethod
    def _softmax(scores: list[float]) -> list[float]:
        top = max(scores)
        e = [math.exp(s - top) for s in scores]
        return [x / sum(e) for x in e]

    def _fit(self, examples: list[tuple[list[int], int]], classes: int) -> None:
        """Stochastic gradient steps with soft thresholding, which leaves most weights at 0."""
        self.weights = [[0.0] * len(self.vocabulary) for _ in range(classes)]
        self.bias = [0.0] * classes
        for epoch in range(EPOCHS):
            rate = RATE / (1 + epoch / 5)
            for x, k in examples:
                p = self._softmax(self._scores(x))
                for c in range(classes):
                    step = rate * ((c == k) - p[c])
                    self.bias[c] += step / 10
                    if abs(step) > 1e-6:
                        w = self.weights[c]
                        for i in x:
                            w[i] += step / math.sqrt(len(x))
            cut = SPARSITY * rate * len(examples)
            for w in self.weights:
                w[:] = [math.copysign(max(0.0, abs(v) - cut), v) for v in w]
        # A paragraph without any n-gram of the vocabulary is unknown by a clear margin.
        self.bias[-1] = max(self.bias[-1], max(self.bias[:-1]) + 4)

    def _calibrate(self, held: list[tuple[list[int], int]]) -> None:
        scored = [(self._scores(x), k) for x, k in held]
        loss = lambda t: -sum(math.log(max(self._softmax([s / t for s in sc])[k], 1e-12)) for sc, k in scored)
        self.temperature = min((0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=loss)
        top = [max(self._softmax([s / self.temperature for s in sc])[:-1]) for sc, k in scored if k == len(self.families) - 1]
        self.threshold = max(0.5, sorted(top)[math.ceil(QUANTILE * len(top)) - 1] if top else 0.5)


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model:
    there = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter("text is not null")
    # The ids first, so that no text but the sampled ones leaves its task.
    ids = there.select(F.col("doc_id").alias("id")).distinct().orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS)
    sampled = there.join(F.broadcast(ids), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    sample = sampled.groupBy("doc_id").agg(F.min("text").alias("text"))
    blocks = _blocks(sample, "doc_id", "text").withColumn("words", _split(F.concat_ws(" ", "lines")))
    # The lines of a wrapped notice are neither unknown nor of a family; only the block is an example.
    notice = _let(_grams(F.col("words")), lambda g: F.greatest(*[_share(g, f) for f in NOTICES])) >= SHARE
    rows = blocks.select(notice.alias("notice"), _units(F.col("words"), F.col("lines"), F.col("start")).alias("units"), F.size("lines").alias("n"))
    rows = rows.select("notice", "n", F.inline("units")).filter("joined or n = 1 or not notice").filter(F.size("words") > 1)
    rows = rows.withColumn("words", F.slice("words", 1, SAMPLE_WORDS))
    return Model([list(r["words"]) for r in rows.orderBy(F.xxhash64("words")).limit(SAMPLE_PARAGRAPHS).select("words").collect()])


def find_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: Model | None = None) -> DataFrame:
    """(doc_id, paragraph, family, probability, share, confirmed) of every
    paragraph that is of a licence family."""
    model = model or fit(docs, doc_id, text)
    families = model.families[:-1]
    cued = lambda words: F.arrays_overlap(words, _literal(model.cues))
    blocks = _blocks(docs, doc_id, text).withColumn("words", _split(F.concat_ws(" ", "lines"))).filter(cued(F.col("words")))
    # A weight per family for each n-gram: a table of the vocabulary's size.
    rows = [(g, [w[i] for w in model.weights]) for i, g in enumerate(model.vocabulary) if any(w[i] for w in model.weights)]
    weights = F.map_from_arrays(_literal([g for g, _ in rows]), F.array(*[F.array(*[F.lit(x) for x in w]) for _, w in rows]))
    zero = F.array(*[F.lit(b) for b in model.bias])

    def likely(grams: F.Column) -> F.Column:
        own = F.array_intersect(grams, _literal([g for g, _ in rows]))
        scores = F.aggregate(own, zero, lambda acc, g: F.zip_with(acc, F.element_at(weights, g), lambda a, w: a + w))
        powers = _let(scores, lambda s: F.transform(s, lambda x: F.exp((x - F.array_max(s)) / model.temperature)))
        return _let(powers, lambda e: _let(F.aggregate(e, F.lit(0.0), lambda a, x: a + x), lambda total: F.transform(e, lambda x: x / total)))

    def result(unit: F.Column, family: F.Column, probability: F.Column, share: F.Column) -> F.Column:
        return F.struct(
            unit["paragraph"].alias("paragraph"), unit["joined"].alias("joined"), family.alias("family"),
            F.round(probability, 6).alias("probability"), F.round(share, 6).alias("share"), (share >= SHARE).alias("confirmed"),
        )

    def of_family(family: F.Column, value) -> F.Column:
        cases = None
        for f in families:
            cases = F.when(family == f, value(f)) if cases is None else cases.when(family == f, value(f))
        return cases

    def sure(p: F.Column, k) -> F.Column:
        """A family's probability if only it and the unknown class are asked."""
        return F.get(p, k) / (F.get(p, k) + F.get(p, F.lit(len(families))))

    def others(unit: F.Column, grams: F.Column, p: F.Column, best: F.Column) -> F.Column:
        """A block's other families, confirmed by these n-grams."""
        confirmed = lambda k, f: _let(_share(grams, f), lambda share: F.when(share >= SHARE, result(unit, F.lit(f), sure(p, F.lit(k)), share)))
        return F.array(*[F.when((best != f) & (sure(p, F.lit(k)) > model.threshold), confirmed(k, f)) for k, f in enumerate(families)])

    def of_unit(unit: F.Column, grams: F.Column, p: F.Column) -> F.Column:
        def found(k: F.Column, family: F.Column, share: F.Column) -> F.Column:
            own = share >= SHARE
            best = F.when(F.get(p, k) > model.threshold, result(unit, family, F.get(p, k), share)).when(unit["joined"] & own & (sure(p, k) > model.threshold), result(unit, family, sure(p, k), share))
            notices = of_family(family, lambda f: _literal(sorted({g for b in _known(f) for g in b})))
            rest = _let(F.when(own, F.array_except(grams, notices)).otherwise(grams), lambda g: others(unit, g, p, family))
            return F.filter(F.when(unit["joined"], F.concat(F.array(best), rest)).otherwise(F.array(best)), F.isnotnull)

        top = F.slice(p, 1, len(families))
        place = F.array_position(top, F.array_max(top)).cast("int") - 1
        return _let(place, lambda k: _let(F.get(_literal(families), k), lambda f: _let(of_family(f, lambda name: _share(grams, name)), lambda share: found(k, f, share))))

    scored = F.flatten(F.transform(F.filter(_units(F.col("words"), F.col("lines"), F.col("start")), lambda u: cued(u["words"])), lambda u: _let(_grams(u["words"]), lambda g: _let(likely(g), lambda p: of_unit(u, g, p)))))

    def told(found: F.Column) -> F.Column:
        """Each family of a block once: see the module's text."""
        some = lambda r, joined, confirmed=None: F.exists(found, lambda o: (o["family"] == r["family"]) & (o["joined"] == joined) & (F.lit(True) if confirmed is None else o["confirmed"]))
        block = lambda r: F.when(r["confirmed"], ~some(r, False, True)).otherwise(~some(r, False))
        line = lambda r: r["confirmed"] | some(r, False, True) | ~some(r, True, True)
        return F.filter(found, lambda r: F.when(r["joined"], block(r)).otherwise(line(r)))

    found = blocks.select("doc_id", scored.alias("found")).filter(F.size("found") > 0)
    return found.select("doc_id", F.explode(_let(F.col("found"), told)).alias("r")).select("doc_id", "r.paragraph", "r.family", "r.probability", "r.share", "r.confirmed")
