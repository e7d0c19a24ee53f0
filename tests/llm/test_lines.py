"""Line dedup and line-frequency quality rules against brute force."""

import random

import pytest

from wordloom.llm import line_dedup, line_quality


def slow_dedup(rows, run):
    """Texts without later repeats, by (id, hash of text, line)."""
    import hashlib

    key = lambda r: (r[0] is not None, r[0] or 0, hashlib.md5((r[1] or "").encode()).digest())
    seen, later = {}, {}
    for row in sorted(set(rows), key=key):
        full = [x.strip(" \t\n\r\x0b\f") for x in (row[1] or "").split("\n")]
        full = [x for x in full if x]
        for k in range(len(full) - run + 1):
            part = tuple(full[k : k + run])
            if seen.setdefault(part, (row, k)) != (row, k):
                later.setdefault(row, set()).add(k)
    out = []
    for row in rows:
        gone = {k + i for k in later.get(row, ()) for i in range(run)}
        kept, n, last = [], 0, False
        full = -1
        lines = (row[1] or "").split("\n")
        number = []
        for x in lines:
            full += bool(x.strip(" \t\n\r\x0b\f"))
            number.append(full if x.strip(" \t\n\r\x0b\f") else None)
        for i, x in enumerate(lines):
            if number[i] is not None:
                drop = number[i] in gone
                n += drop
            else:
                before = [m for m in number[:i] if m is not None]
                after = [m for m in number[i:] if m is not None]
                drop = bool(before and after and before[-1] in gone and after[0] in gone)
            if not drop:
                kept.append(x)
        out.append((row[0], None if row[1] is None else "\n".join(kept), n))
    return sorted(out, key=repr)


@pytest.mark.parametrize("run", [1, 2, 3, 5])
def test_dedup(frame, odd, run):
    r = random.Random(run)
    rows = list(odd)
    pool = [f"line {i}" for i in range(25)] + ["", "  ", "\tline 3 \r"]
    for i in range(60):
        rows.append((100 + i, "\n".join(r.choices(pool, k=r.randint(0, 14)))))
    rows += [(300 + i, rows[-1][1]) for i in range(5)] + [(400, "same\n" * 9)]
    got = line_dedup.dedup_lines(frame(rows), run)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_deleted"]
    assert sorted(((r[0], r.text, r.n_deleted) for r in got.collect()), key=repr) == slow_dedup(rows, run)


def test_every_run_has_a_selected_gram():
    import numpy as np

    r = random.Random(1)
    hashes = np.array([r.choice([1, 2, 3, 4, 5, 6]) for _ in range(200)], np.uint64)
    starts = [s for _, found in line_dedup.select(hashes, 4) for s in found]
    assert sorted(starts) == list(range(197))


def test_dedup_by_words(frame):
    """Passages of fifty words go also where they stand on one or two lines."""
    words = lambda k, n: " ".join(f"w{k}x{i}" for i in range(n))
    one, two, short = words(1, 50), f"{words(2, 30)}\n\n{words(3, 20)}", words(4, 49)
    rows = [(1, one), (2, f"own a\n {one}\nown b"), (3, f"own c\n{two}"), (4, f"{two}\nown d")]
    rows += [(5, f"own e\n{short}"), (6, f"{short}\nown f"), (7, f"{words(2, 30)}\nown g")]
    rows += [(8, f"{words(5, 60)}\n{words(5, 60)}"), (9, f"x\n{one}\ny"), (10, f"x\n{one}\nz")]
    got = line_dedup.dedup_lines(frame(rows), 3, min_words=50)
    assert {r.doc_id: (r.text, r.n_deleted) for r in got.collect()} == {
        1: (one, 0), 2: ("own a\nown b", 1), 3: (f"own c\n{two}", 0), 4: ("own d", 2),
        5: (f"own e\n{short}", 0), 6: (f"{short}\nown f", 0), 7: (f"{words(2, 30)}\nown g", 0),
        8: (words(5, 60), 1), 9: ("x\ny", 1), 10: ("z", 2),
    }


def test_dedup_empty(frame):
    assert line_dedup.dedup_lines(frame([])).collect() == []


def slow_repeats(words, window=8):
    places = {}
    for i in range(len(words) - window + 1):
        places.setdefault(tuple(words[i : i + window]), []).append(i)
    hit = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(window)}
    return len(hit)


def test_figures(frame, odd):
    r = random.Random(9)
    rows = [x for x in odd]
    for i in range(40):
        words = r.choices(["a", "b", "c#", "d|<"], k=r.randint(0, 60))
        rows.append((100 + i, "".join(w + r.choice([" ", "\n", "  ", "\t\n"]) for w in words)))
    rows.append((200, "one two three four five six seven eight " * 2))
    got = line_quality.quality(frame(rows)).collect()
    want = []
    for doc_id, text in rows:
        text = text or ""
        words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text) if w]
        lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\f")]
        n = slow_repeats(words)
        want.append((
            doc_id, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), n, len(words) < 20 or 100 * n > 30 * len(words),
        ))
    columns = ["doc_id", *line_quality.FIGURES, "base_failed"]
    assert sorted((tuple(r[c] for c in columns) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.kept <= (not r.base_failed) for r in got)


@pytest.fixture(scope="module")
def hosts():
    r = random.Random(12)
    word = lambda: "".join(r.choices("abcdefghij", k=6))
    body = lambda n: " ".join(word() for _ in range(n))
    banner = "Share  this page " + " ".join(f"with{i}" for i in range(27))
    rows = [(i, f"{banner}\n{body(30)}\n{body(40)}", "h") for i in range(40)]
    # Almost only boilerplate, whatever its blanks and case.
    rows += [(100 + i, f" {banner.upper()} \n{body(3)}", "h") for i in range(3)]
    # Many copies of one article are one document: their lines are no boilerplate.
    article = [body(30) for _ in range(4)] + [body(60)]
    rows += [(200 + i, "\n".join(article), "h") for i in range(50)]
    # The same banner on another host, on few pages.
    rows += [(400 + i, f"{banner}\n{body(3)}", "other") for i in range(3)]
    # A host of nothing but different pages that all are the banner and a few own words.
    rows += [(1000 + i, f"{banner}\n{body(5)}", "stubs") for i in range(300)]
    return rows


def test_boilerplate(frame, hosts):
    got = {r.doc_id: r for r in line_quality.quality(frame(hosts)).collect()}
    gone = {100, 101, 102, *range(1000, 1300)}
    assert {d for d, r in got.items() if not r.kept} == gone
    assert got[0].n_left == got[0].n_words - 30
    kept = line_quality.screen(frame(hosts))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(
        d for d, _, _ in hosts if d not in gone
    )
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_screen_odd_rows(spark, frame, odd):
    rows = [(1, "word " * 10 + " ".join(f"w{i}" for i in range(40)), None), *odd]
    kept = line_quality.screen(frame(rows)).collect()
    # The long text repeats one word, the accented one a window: both fail a base rule.
    assert sorted((r.doc_id for r in kept)) == [1]
    assert line_quality.screen(frame([])).collect() == []


def test_no_python(frame):
    """Nothing but built-in functions on the main path."""
    plan = line_quality.figures(frame([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
