import random
import re

from sensorgrid.llm.licenses import NOTICES, PHRASES, scan_licenses


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def base(text):
    w, places, labels = words(text), [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        found = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        places += found
        labels |= {label} if found else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_places_like_brute_force(spark):
    rng = random.Random(6)
    parts = [*PHRASES, "under the", "MIT", "license", "cc BY-nc", "Apache License, Version 2", "version", "2", "by", "é", "x\n"]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randrange(30)))) for i in range(150)]
    rows += [(500, None), (501, ""), (None, "under the MIT license"), (3, "cc by nc cc by nc"), (502, "under the mit license " * 3000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n_words int, label string")
    out = scan_licenses(df).collect()
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in out]
    assert sorted(got, key=str) == sorted(((i, *base(t)) for i, t in rows), key=str)
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in out if r.base_labels)
    assert all(r.score == 1 for r in out if r.n_base)
    assert scan_licenses(df.limit(0)).collect() == []


def test_edited_notices(spark):
    rng = random.Random(7)
    rows, want = [], {}
    for i, (notice, label) in enumerate(NOTICES.items()):
        text = notice.split()
        if len(text) > 15:
            text[len(text) // 2 : len(text) // 2 + 1] = ["another", "word"]
        rows.append((i, " ".join([*(f"w{rng.randrange(99)}" for _ in range(40)), *text, "tail"])))
        want[i] = label
    rows.append((99, "redistribution and use of the software without fee or any person in source"))
    out = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(label in out[i].labels.split(",") for i, label in want.items())
    assert out[99].labels == "" and 0 < out[99].score < 0.7


def covered(text, template, k=3):
    """Words of the template under its k-grams that stand in the text, by plain loops."""
    grams = {tuple(text[i : i + k]) for i in range(len(text) - k + 1)}
    return len({q + j for q in range(len(template) - k + 1) if tuple(template[q : q + k]) in grams for j in range(k)})


def test_long_templates_like_brute_force(spark):
    template = [f"t{i}" for i in range(400)]
    rng = random.Random(8)
    rows = [(0, " ".join(template)), (1, " ".join(template[:290])), (2, " ".join(template[:150])), (3, None)]
    for i in range(4, 24):  # scattered words replaced: spans cross the borders of bit columns
        text = template[:]
        for _ in range(rng.randrange(1, 40)):
            text[rng.randrange(400)] = "other"
        rows.append((i, " ".join(["before", *text, "after"])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in scan_licenses(df, {" ".join(template[:130]): "part"}, {" ".join(template): "long"}).collect()}
    for i, text in rows:
        # The share of the phrase, if it is the larger one, is the score.
        share = max(covered(words(text), template) / 400, covered(words(text), template[:130]) / 130)
        assert abs(out[i].score - share) < 1e-12
        long = covered(words(text), template) / 400 >= 0.7
        part = covered(words(text), template[:130]) / 130 >= 0.7
        assert out[i].labels == ",".join(x for x, y in (("long", long), ("part", part)) if y)
    assert [out[i].n_base for i in (0, 1, 2, 3)] == [1, 1, 1, 0] and out[0].base_labels == "part"
