import random

import numpy as np
import pytest
from helpers import ODD, odd_docs

from viewrecon.llm import toxicity as t


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_against_brute_force():
    rng = random.Random(4)
    word = lambda low, high: "".join(rng.choice("abc") for _ in range(rng.randint(low, high)))
    terms = sorted({word(2, 10) for _ in range(40)})
    automaton = t.Automaton(terms)
    for w in [word(0, 12) for _ in range(1500)] + terms:
        want = [(d, i) for i, term in enumerate(terms) if (d := distance(w, term)) <= t.edits_allowed(term)]
        assert automaton.match(w) == (min(want) if want else None), w


def with_swaps(a, b):
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        rows.append([i])
        for j, y in enumerate(b, 1):
            best = min(rows[i - 1][j] + 1, rows[i][j - 1] + 1, rows[i - 1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, rows[i - 2][j - 2] + 1)
            rows[i].append(best)
    return rows[-1][-1]


def test_swapped_letters_are_one_edit():
    rng = random.Random(5)
    word = lambda low, high: "".join(rng.choice("abc") for _ in range(rng.randint(low, high)))
    terms = sorted({word(2, 10) for _ in range(40)})
    automaton = t.Automaton(terms, swaps=True)
    for w in [word(0, 12) for _ in range(1500)] + terms:
        want = [(d, i) for i, term in enumerate(terms) if (d := with_swaps(w, term)) <= t.edits_allowed(term)]
        assert automaton.match(w) == (min(want) if want else None), w
    lexicon = t.Lexicon({"idiot": 5.0, "worthless": 5.0}, frozenset())
    assert lexicon.look_up("idoit") == lexicon.look_up("Idito!") == lexicon.look_up("diiot") == lexicon.look_up("wrothless") == (5.0, 1)
    assert lexicon.look_up("owrthlses") == (5.0, 2) and lexicon.look_up("doiit") is None and lexicon.features("you idoit")[1] > 0


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(t, "STATES", 20)
    automaton = t.Automaton(["worthless", "idiotic"])
    assert automaton.match("wrothless") == (2, 1) and automaton.match("idiotc") == (1, 0) and automaton.match("tree") is None
    assert len(automaton.sets) < 60


def test_quotation_is_not_abuse():
    lexicon = t.Lexicon({"worthless": 5.0}, frozenset())
    abuse, quoted, odd = (lexicon.features(x) for x in ("you are worthless here", 'he said "so worthless" once', "you are WORTHLES5s!! now"))
    assert abuse[0] > 0 and abuse[3] == 0 and quoted[3] > 0 and quoted[0] == 0 and odd[:3].sum() > 0
    assert not lexicon.features("a clean text").any() and not lexicon.features("").any()


def test_long_quotations():
    lexicon = t.Lexicon({"worthless": 5.0}, frozenset())
    long = "one two three four five six seven eight"
    for text in (f'He wrote "{long} worthless {long}." once', f"«{long}, {long}\nworthless {long}»", f"« {long} worthless {long} »", f"(“{long} ‘you worthless man’ {long}”) he said", f'"{long} don\'t be worthless, {long}"'):
        x = lexicon.features(text)
        assert x[3] > 0 and not x[[0, 1, 2, 4, 5]].any(), text
    for text in (f'"{long} worthless {long}', f'worthless {long} "{long}"', f'"{long}" worthless "{long}"', f'"{long} worthless\n\n{long}"', f'"{long} worthless {long} "quoted"', f"the dogs' {long} worthless {long} 'quoted'"):
        x = lexicon.features(text)
        assert x[0] > 0 and x[3] == 0 and x[5] > 0, text
    mixed = lexicon.features(f'worthless "{long} worthless {long}"')
    assert mixed[0] > 0 and mixed[3] > 0 and mixed[5] == pytest.approx(np.log1p(100 / 18))


def test_learns_terms_and_misspellings():
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("aeioulnrst") for _ in range(7)) for _ in range(400)]
    text = lambda bad: " ".join(w for _ in range(60) for w in [rng.choice(vocabulary)] + ([bad] if bad and rng.random() < 0.1 else []))
    rows = [(text("blorfing" if i % 5 == 0 else None), int(i % 5 == 0)) for i in range(400)]
    scorer = t.Scorer([(x, y if "blorfing" in x else 0) for x, y in rows])
    assert set(scorer.lexicon.weights) == {"blorfing"}
    assert scorer.score(text(None)) < 0.2 < 0.6 < scorer.score(text(None) + " Blorfing! you blorfing")
    assert scorer.score(text(None) + " blorfng bl0rfing") > scorer.score(text(None))
    assert 0 <= scorer.score("") < 0.5


@pytest.mark.parametrize("rows", [[], [("a b", 0)], [("a b", 1)]])
def test_too_few_labels(rows):
    assert 0 <= t.Scorer(rows).score("a b") <= 1


def test_whole_table_and_held_out(spark, sf_dir):
    sf = sf_dir.replace("sf0.001", "sf0.1")
    rows = t.op6_toxicity(spark, sf).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == 10_000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.95


def test_odd_rows(spark):
    docs = odd_docs(spark)
    scorer = t.Scorer([("bad bad worse", 1), ("good", 0)] * 20)
    assert t.score(docs, scorer).count() == len(ODD)
    assert t.score(docs.limit(0), scorer).count() == 0


def test_odd_rows_score_as_stated(spark):
    """Null scores like empty, repeated rows alike, a very long text whole; columns beside are not read."""
    docs = odd_docs(spark).selectExpr("*", "1 AS score", "2 AS held_out", "'x' AS predicted", "3 AS label")
    out = t.score(docs, t.Scorer([("bad bad worse", 1), ("good", 0)] * 20))
    assert out.columns == ["doc_id", "score"]
    found = {}
    for r in out.collect():
        found.setdefault(r.doc_id, set()).add(r.score)
    assert len(found) == len({i for i, _ in ODD}) and all(len(s) == 1 for s in found.values())
    assert found[1] == found[2] and all(0 <= min(s) <= 1 for s in found.values())
