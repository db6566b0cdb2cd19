"""Back-off n-gram language models in ARPA text form, and perplexity under them."""

from __future__ import annotations

import gzip
import math
import os
from collections import Counter, OrderedDict, defaultdict
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskit.schema import BadInput

BEGIN, END, UNKNOWN = "<s>", "</s>", "<unk>"


class LanguageModel:
    """log10 probabilities and back-off weights by n-gram, of words joined by a space."""

    def __init__(self, order: int, grams: Mapping[str, tuple[float, float]]) -> None:
        self.order, self.grams = order, dict(grams)

    @classmethod
    def parse(cls, text: str) -> LanguageModel:
        grams: dict[str, tuple[float, float]] = {}
        n = order = 0
        for line in text.splitlines():
            line = line.strip()
            if line.startswith("\\") and line.endswith("-grams:"):
                n = int(line[1:].split("-", 1)[0])
                order = max(order, n)
            elif line == "\\end\\":
                break
            elif n and line:
                parts = line.split("\t") if "\t" in line else line.split(" ")
                words = parts[1].split(" ") if "\t" in line else parts[1 : n + 1]
                rest = parts[2:] if "\t" in line else parts[n + 1 :]
                grams[" ".join(words)] = float(parts[0]), float(rest[0]) if rest else 0.0
        if not order:
            raise BadInput("no n-grams in the model")
        return cls(order, grams)

    def score(self, context: Sequence[str], word: str) -> float:
        """log10 P(word | context)."""
        word = word if word in self.grams else UNKNOWN
        context = [c if c in self.grams else UNKNOWN for c in context[max(0, len(context) - self.order + 1) :]]
        back = 0.0
        while True:
            found = self.grams.get(" ".join([*context, word]))
            if found:
                return back + found[0]
            if not context:
                return back - 100.0
            back += self.grams.get(" ".join(context), (0.0, 0.0))[1]
            context = context[1:]

    def perplexity(self, text: str) -> float:
        """Of one sentence between its begin and end marks: 10 to the minus mean log10 probability of its words and the end."""
        words = text.split()
        history = [BEGIN]
        total = 0.0
        for w in [*words, END]:
            total += self.score(history, w)
            history = [*history, w][-max(1, self.order - 1) :]
        return 10 ** (-total / (len(words) + 1))


def estimate(sentences: Sequence[str], order: int = 2, discount: float = 0.5) -> str:
    """A model of sentences by absolute discounting, in ARPA form: for tests and for small domains."""
    counts: list[Counter] = [Counter() for _ in range(order + 1)]
    for s in sentences:
        words = [BEGIN, *s.split(), END]
        for n in range(1, order + 1):
            counts[n].update(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
    out = ["\\data\\"]
    vocabulary = {w for (w,) in counts[1]} - {BEGIN}
    total = sum(c for (w,), c in counts[1].items() if w != BEGIN) or 1
    prob: dict[tuple[str, ...], float] = {(w,): max(counts[1][(w,)] - discount, 0) / total for w in vocabulary}
    prob[(UNKNOWN,)] = 1 - sum(prob.values())
    back: dict[tuple[str, ...], float] = {}
    for n in range(2, order + 1):
        after: dict[tuple[str, ...], list] = defaultdict(list)
        for g, c in counts[n].items():
            after[g[:-1]].append((g, c))
        for context, own in after.items():
            whole = sum(c for _, c in own)
            for g, c in own:
                prob[g] = (c - discount) / whole
            lower = sum(prob.get(g[1:], 0) for g, _ in own)
            back[context] = discount * len(own) / whole / max(1 - lower, 1e-9)
    prob[(BEGIN,)] = 10**-99
    by = [sorted(g for g in prob if len(g) == n) for n in range(1, order + 1)]
    out += [f"ngram {n}={len(g)}" for n, g in enumerate(by, 1)]
    for n, grams in enumerate(by, 1):
        out.append(f"\n\\{n}-grams:")
        out += [f"{math.log10(max(prob[g], 1e-99)):.6f}\t{' '.join(g)}" + (f"\t{math.log10(max(back[g], 1e-99)):.6f}" if g in back else "") for g in grams]
    return "\n".join([*out, "\n\\end\\"])


def models_in(folder: str) -> dict[str, str]:
    """Path by language of ``<language>.arpa`` (also ``.arpa.gz``) and ``<language>.binary``; of several, the first of these, as a compiled model can't be read. A stem that is no tag is left out."""
    import re

    from corpuskit.functions.tags import WELL_FORMED

    found: dict[str, str] = {}
    for kind in ("arpa", "arpa.gz", "binary"):
        for name in sorted(os.listdir(folder)):
            m = re.fullmatch(rf"(.+)\.{re.escape(kind)}", name)
            if m and re.match(WELL_FORMED, m[1]):
                found.setdefault(m[1], os.path.join(folder, name))
    return found


#: n-grams that a worker keeps in all, in the models used last; a larger model is kept alone.
KEPT_GRAMS = 8_000_000
_loaded: OrderedDict[str, LanguageModel] = OrderedDict()


def load(path: str) -> LanguageModel:
    """Read once a worker, as long as its models have no more than KEPT_GRAMS n-grams. Only the text form can be read here."""
    if path in _loaded:
        _loaded.move_to_end(path)
        return _loaded[path]
    if path.endswith(".binary"):
        raise BadInput(f"{path}: compiled models can't be read; keep the .arpa file beside it")
    with gzip.open(path, "rt", encoding="utf-8") if path.endswith(".gz") else open(path, encoding="utf-8") as f:
        model = LanguageModel.parse(f.read())
    while _loaded and sum(len(m.grams) for m in _loaded.values()) + len(model.grams) > KEPT_GRAMS:
        _loaded.popitem(last=False)
    _loaded[path] = model
    return model


def perplexity(text: Column, lang: Column, models: Mapping[str, str | LanguageModel]) -> Column:
    """Float column: perplexity under the language's model, line breaks as spaces; null without a model. Models are paths that every executor can read, or, if they are small, the models themselves."""
    known = dict(models)

    @F.pandas_udf("float")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, langs in batches:
            out = pd.Series([None] * len(texts), dtype="float32")
            for g, at in langs.groupby(langs).indices.items():  # a batch asks for each language's model once
                if m := known.get(g):
                    model = load(m) if isinstance(m, str) else m
                    for k in at:
                        t = texts.iloc[k]
                        out.iloc[k] = model.perplexity(t) if t is not None else None
            yield out

    return run(F.replace(text, F.lit("\n"), F.lit(" ")), lang)
