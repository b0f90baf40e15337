"""Cross-entropy difference over every word of a corpus, against counts by brute force."""

from __future__ import annotations

import math
import random
from collections import Counter

from docmart.llm import lm_score


def test_words_beyond_any_fixed_number_count(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "BLOCK", 4000)
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{int(40000 * rng.random() ** 3)}" for _ in range(rng.randint(1, 120)))) for i in range(300)]
    rows += [(300, None), (301, " ! "), (None, rows[0][1]), rows[3]]
    good = {i for i in range(300) if i % 5 == 0}
    words = [(t or "").replace("!", " ").split() for _, t in rows]
    assert len({w for x in words for w in x}) > 4096
    single, pairs, seen = [Counter(), Counter()], [Counter(), Counter()], [Counter(), Counter()]
    for (i, _), text in zip(rows, words, strict=True):
        for m in [0, 1] if i in good else [0]:
            for a, b in zip([None, *text], text, strict=False):
                single[m][b] += 1
                pairs[m][a, b] += 1
                seen[m][a] += 1
    size = len(single[0]) + 2

    def p(m, a, b):
        low = (single[m][b] + 1) / (single[m].total() + size)
        return 0.7 * pairs[m][a, b] / seen[m][a] + 0.3 * low if seen[m][a] else low

    want = Counter()
    for (i, _), text in zip(rows, words, strict=True):
        each = [math.log(p(0, a, b)) - math.log(p(1, a, b)) for a, b in zip([None, *text], text, strict=False)]
        want[i, len(text), round(sum(each) / len(each), 6) + 0.0 if each else 0.0] += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = lm_score.score(docs, spark.createDataFrame([(i,) for i in good], "doc_id long")).collect()
    assert Counter((r[0], r[1], round(r[2], 6) + 0.0) for r in found) == want
