"""The url filter's language models against exact counts in Python."""

import math
import random
from collections import Counter

import pytest

from tenderline.llm.urls import ORDER, SMOOTHING, judged

RULES = (("allow", "good", "/"), ("block", "bad", "/"))


def exact_ratios(urls):
    """Per url the log-likelihood difference by character, from counts of every context as it is."""
    told = {True: [u for u in urls if u.startswith("h://good/")], False: [u for u in urls if u.startswith("h://bad/")]}
    tables = {}
    for good, own in told.items():
        pairs, alone = Counter(), Counter()
        for url in own:
            text = "\0" * ORDER + url
            for at in range(ORDER, len(text)):
                for k in range(ORDER + 1):
                    pairs[text[at - k : at + 1]] += 1
                    alone[k, text[at - k : at]] += 1
        tables[good] = pairs, alone
    found = {}
    for url in urls:
        text, total = "\0" * ORDER + url, 0.0
        for good, (pairs, alone) in tables.items():
            for at in range(ORDER, len(text)):
                chance = 1 / 256
                for k in range(ORDER + 1):
                    chance = max((pairs[text[at - k : at + 1]] + SMOOTHING * chance) / (alone[k, text[at - k : at]] + SMOOTHING), 1e-12)
                total += math.log(chance) if good else -math.log(chance)
        found[url] = total / len(url)
    return found


@pytest.mark.parametrize("urls, most", [(6000, 1 << 20), (300, 200), (300, 0)])
def test_ratios_equal_exact_counts(spark, urls, most):
    """With more contexts than 524,288 slots could keep apart, and with grams that are not broadcast."""
    draw = random.Random(urls)
    rows = [(k, f"h://{('good', 'bad', 'else')[k % 3]}/" + "".join(draw.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=40))) for k in range(urls)]
    rows += [(urls + k, rows[k][1]) for k in range(9)]
    found = judged(spark.createDataFrame(rows, "page_id long, url string"), RULES, most).collect()
    assert len(found) == len(rows)
    exact, url = exact_ratios([u for _, u in rows[: urls]] + [u for _, u in rows[urls:]]), dict(rows)
    cuts = [exact[url[r["page_id"]]] - r["score"] for r in found if r["score"] is not None]
    assert len(cuts) == sum("else" in u for u in url.values())
    assert max(cuts) - min(cuts) < 1e-9
