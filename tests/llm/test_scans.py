import random

import numpy as np
import pytest

from scriptorium.llm import scans as S

NOUNS = "lampe porte source vigne nuit jardin moisson maison colline rivière prière parole montagne témoin chemin serviteur".split()


def page(rng, lines, title, k, misread=0.0, cut=True):
    """A page of wrapped text with a header and a number; returns the lines and the truth."""
    words = []
    while len(words) < lines * 9:
        words += f"La {rng.choice(NOUNS)} garde la {rng.choice(NOUNS)} de la {rng.choice(NOUNS)} et la {rng.choice(NOUNS)} demeure.".split()
    out, truth = [title.upper()], [(0, "header")]
    now = ""
    for w in words:
        bad = rng.random() < misread and len(w) > 4 and "m" in w
        w = w.replace("m", "rn", 1) if bad else w
        if len(now) + len(w) + 1 > 60:
            room = 60 - len(now) - 2
            if cut and len(w) > 6 and room >= 3 and w.isalpha() and rng.random() < 0.5:
                h = min(room, len(w) - 3)
                truth.append((len(out), "break"))
                out.append(f"{now} {w[:h]}-")
                now = w[h:]
            else:
                out.append(now)
                now = w
        else:
            now = f"{now} {w}".strip()
        if bad:
            truth.append((len(out), "bad"))
    out += [now, f"— {k} —"]
    truth.append((len(out) - 1, "page_no"))
    return out, truth


@pytest.fixture(scope="module")
def scans(spark):
    rng = random.Random(12)
    rows, truth = [], set()
    for i in range(40):
        title = f"La {rng.choice(NOUNS)} de la {rng.choice(NOUNS)}"
        lines = []
        for k in range(3):
            new, t = page(rng, 14, title, 20 + k, 0.05 if i < 10 else 0.0)
            truth |= {(i, len(lines) + a + 1, kind) for a, kind in t if kind != "bad"}
            lines += new
        rows.append((i, "\n".join(lines), title, "Anselme Garsel", 1))
    rows += [(100, None, None, None, 1), (101, "", "x", "y", 1), (102, "Un seul paragraphe.\n\nUn autre.", "x", None, 1), (103, "mot " * 20_000, "x", None, 1)]
    df = spark.createDataFrame(rows, "md_id long, body string, title string, preacher string, line_no int")
    lines, fixes = S.scanned_lines(df)
    return df, truth, {(r.id, r.line_no, r.kind) for r in lines.collect()}, {r.word: r.fix for r in fixes.collect()}


@pytest.mark.parametrize("kind", ["header", "page_no", "break"])
def test_lines(scans, kind):
    _, truth, got, _ = scans
    want, have = {x for x in truth if x[2] == kind}, {x for x in got if x[2] == kind}
    assert len(want & have) / len(want) > 0.95 and len(want & have) / len(have) > 0.9


def test_misread_words(scans):
    _, _, got, fixes = scans
    assert {"larnpe": "lampe", "chernin": "chemin"}.items() <= fixes.items() or len(fixes) >= 2
    assert all(w.replace("rn", "m", 1) == f for w, f in fixes.items())
    assert {i for i, _, k in got if k == "misread"} <= set(range(10))


def test_nothing_for_other_texts(scans):
    assert not any(i >= 100 for i, _, _ in scans[2])


def test_repaired(scans, spark):
    df = scans[0]
    text = {r.id: r.text for r in S.repaired(df).collect()}
    assert set(text) == set(range(40))
    assert not any("—" in t or "\n" in t.replace("\n\n", "") for t in text.values())
    assert "rnoisson" not in text[0] and "- " not in text[20]


def test_empty_table(scans):
    lines, fixes = S.scanned_lines(scans[0].limit(0))
    assert lines.isEmpty() and fixes.isEmpty()


def test_repairs():
    assert "épée" in S.repairs("épéc") and "maison" in S.repairs("ma1s0n") and "témoin" in S.repairs("térnoin") and "fenêtre" in S.repairs("fen8tre") and "révèle" in S.repairs("re'vèle") and "remplit" in S.repairs("rempl!t")
    assert len(S.repairs("c" * 40 + "e" * 40, 1)) == 80


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    import itertools

    syms = np.array([0, 3, -1, 7, 5])
    emit = rng.normal(size=(3, S.SYMBOLS))
    at = [k for k, s in enumerate(syms) if s >= 0]
    start = np.log([0.6, 0.3, 0.1])
    score = lambda p: start[p[0]] + sum(emit[s, syms[k]] for s, k in zip(p, at)) + sum(np.log(S._T)[a, b] for a, b in zip(p, p[1:]))
    best = max(itertools.product(range(3), repeat=len(at)), key=score)
    assert tuple(S.viterbi(syms, S.LineModel(emit))[at]) == best


def test_reassembly():
    lines = ["LE TITRE", "La lu-", "— 3 —", "mière du soir, peut-", "être.", "", "La rn0isson."]
    states = np.array([1, 0, 2, 0, 0, 0, 0])
    assert S.reassemble(lines, states, {"rn0isson": "moisson"}) == "La lumière du soir, peut-être.\n\nLa moisson."
