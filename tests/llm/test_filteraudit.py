"""The filter audit against plain Python, and its tries on their own."""

import random
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from annexport.llm import filteraudit
from annexport.llm.filteraudit import Ranges, Trie, text_mask

KIND = "doc_id long, text string, lang string, mask int, origin string, body string, part string, `_c` int"


def brute_masks(rows):
    least = {}
    for i, text, *_ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    out = []
    for i, text, lang, *_ in rows:
        t = text or ""
        words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in t).split(" ") if w]
        fails = ""
        fails += "A" * (len(words) < 100)
        fails += "B" * (100 * len(set(words)) < 80 * len(words))
        fails += "C" * (100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t))
        fails += "D" * any(c in "#$%&*|" for c in t)
        fails += "E" * (i is not None and i > least[t])
        out.append((i, lang or "", fails))
    return out


def brute_audit(masks, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    report = {}
    by_part = defaultdict(list)
    for i, part, fails in masks:
        by_part[part].append((i, fails))
    for part, rows in by_part.items():
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = list(rows)
            for step, letter in enumerate(order):
                gone = [r for r in left if letter in r[1]]
                left = [r for r in left if letter not in r[1]]
                shapley[letter] += len(gone)
                report[part, "".join(order), step + 1] = [
                    len(left), len(gone), sum(letter in f for _, f in rows) - len(gone), sum(f == letter for _, f in rows),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), letter,
                ]
        for (p, _, _), row in report.items():
            if p == part:
                row[-1] = shapley[row[-1]]
    return report


def documents():
    rng = random.Random(3)
    words = ["the", "Cat", "SAT", "on", "é", "😀", "a#b", "mat", "x", " y"]
    rows = [(None, "same", None), (None, "same", "en"), (4, "same", "de"), (4, "same", "de"), (3, None, "en"), (5, "", ""), (5, " \v\f", "en")]
    rows += [(10, "word " * 30_000, "en"), (11, "word " * 30_000, "en"), (12, "word " * 30_000 + "x", "en"), (13, "x" * 200_000, None)]
    texts = ["common beginning " * 40 + " ".join(rng.choice(words) for _ in range(rng.randint(0, 200))) for _ in range(60)]
    texts += [" ".join(f"w{rng.randint(0, 500)}" for _ in range(rng.randint(0, 300))) for _ in range(60)]
    texts += [t[: rng.randint(0, len(t))] for t in texts]
    for k in range(900):
        rows.append((rng.randint(0, 800), "hot copy" if k % 3 == 0 else rng.choice(texts), rng.choice(["en", "de", None, "fr"])))
    return [(*r, 1, "o", "b", "p", 2) for r in rows]


@pytest.mark.parametrize("block,bytes_each", [(filteraudit.BLOCK, filteraudit.RANGE), (20_000, 4_000)])
def test_masks_and_report_equal_brute_force(spark, block, bytes_each):
    rows = documents()
    docs = spark.createDataFrame(rows, KIND).repartition(7)
    masks = filteraudit.filter_masks(docs, block=block, bytes_each=bytes_each)
    found = masks.collect()
    letters = lambda m: "".join(x for k, x in enumerate("ABCDE") if m >> k & 1)
    want = brute_masks(rows)
    assert Counter((r.doc_id, r.part, letters(r.mask)) for r in found) == Counter(want)
    rng = random.Random(4)
    labels = [(rng.choice([None, *range(900)]), rng.choice([0, 1, None]), rng.choice([0, 0, 1])) for _ in range(700)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit("clash"))
    report = filteraudit.audit(masks, table).collect()
    assert {(r[0], r[1], r[2]): list(r[3:]) for r in report} == brute_audit(want, labels)


def test_empty(spark):
    docs = spark.createDataFrame([], KIND)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filteraudit.audit(filteraudit.filter_masks(docs), labels).count() == 0
    docs = spark.createDataFrame([(None,) * 8], KIND)
    rows = filteraudit.audit(filteraudit.filter_masks(docs), labels).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {""} and sum(r.removed for r in rows) == 120


def test_trie_holds_every_text_once():
    rng = random.Random(1)
    texts = {bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 40))) for _ in range(3000)} | {b"", b"a" * 5000, b"a" * 4999 + b"b"}
    trie = Trie()
    for text in [*texts, *texts]:
        node = trie.place(text)
        assert node[2] in (None, text)
        node[2] = text
    assert sorted(trie.values()) == sorted(texts)


def test_ranges_are_even_and_keep_equal_texts_together():
    rng = random.Random(2)
    long = b"p" * filteraudit.PREFIX
    texts = [bytes(rng.choice(b"abcd") for _ in range(20)) for _ in range(4000)] + [long + bytes([rng.randint(0, 255), k % 256]) for k in range(2000)]
    ranges = Ranges([(t[: filteraudit.PREFIX], len(t)) for t in texts], 2000)
    held = Counter(ranges.of(t) for t in texts)
    assert max(held.values()) < 400 and len(held) > 50
    order = sorted(texts[:4000])
    assert [ranges.of(t) for t in order] == sorted(ranges.of(t) for t in order)  # by ranges of prefixes
    light = [len(s) for s in ranges.splitters if s < b"p"]
    assert sum(light) / len(light) < 9  # no longer than they need be: 4,000 texts of four letters part within 6 or so


def test_mask_bits():
    assert text_mask(b"a " * 100) == 2 and text_mask(b" ".join(b"w%d" % k for k in range(100))) == 0
    assert text_mask("É".encode() * 9 + b"A") == 1 and text_mask("É".encode() * 8 + b"A") == 1 | 4 and text_mask(b"|") == 9
