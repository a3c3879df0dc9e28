"""Op 6: base counts and diagonals against plain versions, edits, no Python in the plan."""
import random
import re

from metroscope.llm import licenses as L


def words_of(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def base(text):
    w, starts, labels = words_of(text), [], set()
    for p, label in L.PHRASES.items():
        p = p.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)), labels


def coverage(text):
    """Best template coverage and verified labels by plain diagonal voting."""
    w, best, labels = words_of(text), 0.0, set()
    for label, tmpl in L.TEMPLATES:
        t = words_of(tmpl)
        diagonals = {}
        for i in range(len(w) - 2):
            for j in range(len(t) - 2):
                if w[i:i + 3] == t[j:j + 3]:
                    diagonals.setdefault(i - j, []).append((i, j))
        runs = []
        for d, hits in sorted(diagonals.items(), key=lambda x: (min(x[1]), x[0])):
            lo, hi = min(i for i, _ in hits), max(i for i, _ in hits) + 3
            if runs and abs(d - runs[-1]["d"]) <= L.MAX_SHIFT and lo - runs[-1]["hi"] <= L.MAX_GAP:
                runs[-1]["hits"] += hits
                runs[-1] |= {"d": d, "hi": max(hi, runs[-1]["hi"])}
            else:
                top = max([hi, *[r["hi"] for r in runs]])
                runs.append({"d": d, "hi": top, "hits": list(hits)})
        for r in runs:
            c = len({j + x for _, j in r["hits"] for x in range(3)}) / len(t)
            best = max(best, min(c, 1.0))
            if c >= L.COVERAGE:
                labels.add(label)
    return labels, best


def check(docs, rows):
    got = sorted(((str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9))
                  for r in L.scan(docs).collect()), key=str)
    want = []
    for i, t in rows:
        *b, own = base(t)
        labels, score = coverage(t)
        want.append((str(i), *b, ",".join(sorted(own | labels)), round(score, 9)))
    assert got == sorted(want, key=str)


def test_base_and_diagonals(docs_of):
    rng = random.Random(7)
    rows = [(1, "CC BY cc-by all rights reserved"), (2, "x General Public License cc by cc by"), (3, "K CC BY İ cc É by"), (4, "cc by"),
            (5, "all rights reserved all rights reserved."), (6, "ALL RIGHTS\nRESERVED cc"), (7, "general public licenses ccby")]
    fill = lambda n: " ".join(rng.choice("the of this license under a is to".split()) for _ in range(n))
    for n, (_, text) in enumerate(L.TEMPLATES):
        w = text.split()
        for copy in range(4):
            own = list(w)
            for _ in range(copy):  # edits move the rest to a neighbouring diagonal
                at = rng.randrange(len(own))
                own[at:at + rng.randint(0, 1)] = rng.choice([[], ["very"], ["very", "new"]])
            rows.append((100 * n + copy + 10, f"{fill(rng.randint(0, 9))}. {' '.join(own)} {fill(rng.randint(0, 9))}"))
    rows.append((9000, " ".join(t for _, t in L.TEMPLATES) * 2))
    check(docs_of(rows), rows)


def test_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check(docs, [(r.doc_id, r.text) for r in docs.collect()])


def test_awkward_rows(docs_of, awkward):
    rows = awkward + [(8, "Released under the MIT License. All rights reserved.")] * 2
    for extra in (False, True):
        check(docs_of(rows, extra), rows)
    assert L.scan(docs_of([])).count() == 0


def test_no_python_in_the_plan(spark, sf):
    plan = L.scan(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("EvalPython|InArrow|InPandas|ArrowEval", plan)
