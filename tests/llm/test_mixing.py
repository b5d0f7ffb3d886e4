import hashlib
import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest

from ledgerloom.llm import mixing
from ledgerloom.llm.mixing import Mix, leaf_budgets, mixed, pour

from .tables import frame, odd_rows

MIX = Mix(
    domains={"a": ["src0"], "b": ["src1", "src2"]}, domain_weights={"a": 1, "b": 3}, language_weights={"en": 2},
    source_weights={"src2": 5}, budget=(3, 2), max_epochs=3,
)


def share(budget, children):
    """children {name: (held, weight)}: fill the children that are short, share the rest, again and again."""
    given, open_, left = {}, dict(children), budget
    while open_:
        total = sum(w for _, w in open_.values())
        short = {k for k, (held, w) in open_.items() if held <= Fraction(left * w, total)}
        if not short:
            return given | {k: left * w // total for k, (_, w) in open_.items()}
        for k in short:
            given[k] = open_.pop(k)[0]
            left -= given[k]
    return given


def budgets_brute(leaves, mix):
    held = {k: v * mix.max_epochs for k, v in leaves.items()}
    out = {(): sum(leaves.values()) * mix.budget[0] // mix.budget[1]}
    for depth, weights in enumerate((mix.domain_weights, mix.language_weights, mix.source_weights)):
        level = {}
        for parent, budget in out.items():
            children = defaultdict(int)
            for k, v in held.items():
                if k[:depth] == parent:
                    children[k[depth]] += v
            given = share(budget, {k: (v, weights.get(k, mix.other)) for k, v in children.items()})
            level |= {(*parent, k): v for k, v in given.items()}
        out = level
    return out


def mixed_brute(rows, mix):
    domain = {s: d for d, sources in mix.domains.items() for s in sources}
    leaves = defaultdict(list)
    for i, text, lang, source in rows:
        n = len(re.findall(mixing.TOKEN, text or ""))
        if n:
            leaves[domain.get(source, mix.rest), lang or "(none)", source or "(none)"].append((i, n))
    budgets = budgets_brute({k: sum(n for _, n in v) for k, v in leaves.items()}, mix)
    out = []
    for leaf, docs in leaves.items():
        epochs, left = divmod(budgets[leaf], sum(n for _, n in docs))
        out += [(i, *leaf, e, n, n) for e in range(epochs) for i, n in docs]
        key = lambda d: (hashlib.md5(f"{mix.seed}:{epochs}:{'' if d[0] is None else d[0]}".encode()).hexdigest(), d[0] or -1)
        for i, n in sorted(docs, key=key):
            if left > 0:
                out.append((i, *leaf, epochs, n, min(n, left)))
            left -= n
    return out


@pytest.mark.parametrize("seed", [1, 2, 3, 4, 5, 6])
def test_budgets_against_repeated_sharing(spark, seed):
    rng = random.Random(seed)
    leaves = {(rng.choice("ab"), rng.choice(["en", "de", "fr"]), f"src{rng.randrange(4)}"): rng.choice([1, 7, 100, 5000]) for _ in range(15)}
    mix = Mix({}, {"a": rng.randint(1, 5), "b": 2}, {"en": 3}, {"src0": 9}, budget=(rng.choice([1, 3, 9]), 2), max_epochs=rng.choice([1, 4]))
    table = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "domain string, language string, origin string, tokens long")
    got = {(r.domain, r.language, r.origin): r.given for r in leaf_budgets(table, mix).collect()}
    assert got == budgets_brute(leaves, mix)


def test_what_a_short_child_leaves_goes_to_its_siblings(spark):
    nodes = [("p", "x", 100, 10, 1), ("p", "y", 100, 500, 1), ("p", "z", 100, 500, 2), ("q", "x", 30, 5, 1), ("q", "y", 30, 5, 9)]
    table = spark.createDataFrame(nodes, "up string, name string, budget long, held long, weight long")
    got = {(r.up, r.name): r.given for r in pour(table, ["up"], "name").collect()}
    assert got == {("p", "x"): 10, ("p", "y"): 30, ("p", "z"): 60, ("q", "x"): 5, ("q", "y"): 5}


@pytest.mark.parametrize("seed", [3, 8])
def test_odd_rows_against_brute_force(spark, seed):
    rows = [*odd_rows(seed), (None, "a row without id", "en", "src1")]
    order = lambda r: tuple(map(str, r))
    assert sorted((tuple(r) for r in _columns(mixed(frame(spark, rows), MIX)).collect()), key=order) == sorted(mixed_brute(rows, MIX), key=order)


def _columns(df):
    return df.select("doc_id", "domain", "language", "origin", "epoch", "n_tokens", "taken")


def test_empty_table(spark):
    assert mixed(frame(spark, []), MIX).count() == 0
