import random
import time

import numpy as np
import pyarrow as pa
import pytest

from tallywatch.llm import licenses
from tallywatch.llm.queries import QUERIES
from tests.llm.conftest import PROSE

NOTICES = {
    "MIT": "released under the mit license", "Apache-2.0": "licensed under the apache license, version 2.0",
    "GPL-3.0": "gnu general public license, version 3", "CC-BY-NC-4.0": "licensed under cc by-nc 4.0",
    "All rights reserved": "all rights reserved",
}


def test_whole_table_has_all_notices(spark, sf_dir, documents):
    got = {(r.doc_id, r.license) for r in QUERIES["op10_licenses"](spark, sf_dir).collect()}
    want = {(r["doc_id"], name) for r in documents for name, line in NOTICES.items() if line in (r["text"] or "").lower()}
    assert want and got == want


def test_bands_hardly_miss():
    assert licenses.miss_probability(licenses.least_similarity()) < 0.003
    assert licenses.miss_probability(licenses.least_similarity(1.0)) < 1e-6


@pytest.mark.parametrize("changed, found", [(0, True), (2, True), (30, False)])
def test_changed_copies_of_each_template(spark, changed, found):
    rng = random.Random(changed)
    rows, want = [], set()
    for n, (name, text) in enumerate(licenses.TEMPLATES):
        words = text.split()
        if len(words) < 30:
            continue
        for i in rng.sample(range(len(words)), min(changed, len(words))):
            words[i] = "changed"
        filler = [f"f{rng.randrange(1000)}" for _ in range(200)]
        at = rng.randrange(200)
        rows.append((n, " ".join(filler[:at] + words + filler[at:])))
        want.add((n, name))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.doc_id, r.license) for r in licenses.find_licenses(docs, containment=0.7).collect()}
    assert want <= got if found else not got


def test_scan_equals_containment_of_every_window():
    rng = random.Random(8)
    named = (("A", " ".join(f"a{i}" for i in range(20))), ("B", "b0 b1 b2 b3"), ("A", "a5 a6 a7"))
    known, texts = licenses.templates(named), []
    for _ in range(60):
        words = [rng.choice("xyz") for _ in range(rng.randrange(30))]
        for text in rng.sample([t for _, t in named], rng.randrange(3)):
            part = text.split()
            if rng.random() < 0.3:
                part[rng.randrange(len(part))] = "gone"
            at = rng.randrange(len(words) + 1)
            words[at:at] = part
        texts.append(" ".join(words))
    got = {(row, i): round(share, 9) for row, i, _, share in licenses.scan(pa.array(texts), licenses.Index(known))}
    for row, text in enumerate(texts):
        shingles, _ = licenses._shingles(pa.array([text]))
        for i, template in enumerate(known):
            reach = 2 * template.size
            share = max((len(np.unique(w[np.isin(w, template.shingles)])) / len(template.shingles)
                         for w in (shingles[a: a + reach] for a in range(len(shingles)))), default=0)
            if share == 1:
                assert got[row, i] == 1
            elif share < 0.8:
                assert (row, i) not in got


def test_odd_rows(frame, odd_pairs):
    notice = "Released under the MIT License."
    pairs = [*odd_pairs, (20, notice), (20, notice), (None, PROSE + "\n" + notice), (21, "Released under the MIT"),
             (22, f"{notice} {notice}")]
    got = licenses.find_licenses(frame(pairs)).collect()
    assert sorted((str(r.doc_id), r.license, r.begin) for r in got) == [
        ("20", "MIT", 0), ("20", "MIT", 0), ("22", "MIT", 0), ("None", "MIT", len(PROSE.split()))]
    assert licenses.find_licenses(frame([])).count() == 0


def test_many_templates_of_a_size_cost_little_more_than_few():
    rng = random.Random(4)
    texts = pa.array([" ".join(rng.choices("abcdefgh", k=4000)) for _ in range(20)])

    def seconds(n):
        named = tuple((f"L{i}", " ".join(f"w{i}x{k}" for k in range(30))) for i in range(n))
        index, begin = licenses.Index(licenses.templates(named)), time.process_time()
        licenses.scan(texts, index)
        return time.process_time() - begin

    assert min(seconds(500) for _ in range(3)) < 2 * min(seconds(5) for _ in range(3))
