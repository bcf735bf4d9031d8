"""Quality bounds come from their groups."""

import sys
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
from obsmill.llm import quality_rules


def test_bounds_differ_between_unlike_groups(spark):
    rng = np.random.default_rng(6)

    def prose(lines, again=0, capitals=0.0):
        rows = [" ".join(f"w{rng.integers(1 << 40)}" for _ in range(8)) for _ in range(lines)]
        rows += rows[:again]
        return "\n".join(x.upper() if rng.random() < capitals else x for x in rows)

    rows = [(i, prose(20), "en", "plain") for i in range(200)] + [(1000 + i, prose(20, int(rng.integers(0, 3)), 0.3), "en", "lists") for i in range(200)]
    odd = prose(20, 2)
    rows += [(2000, odd, "en", "plain"), (2001, odd, "en", "lists"), (2002, prose(20, 0, 1.0), "en", "plain"), (2003, prose(20) + "\n" + "# " * 30, "en", "plain"), (2004, prose(20) + " &", "en", "plain")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    for x in ("dup_line_rate", "repeat_rate", "upper_rate"):
        assert got[1000][f"{x}_bound"] > 1.5 * got[0][f"{x}_bound"]
    assert [got[i]["kept"] for i in (2000, 2001, 2002, 2003, 2004)] == [False, True, False, False, True]
    assert all(got[i]["kept"] for i in range(200))
    assert sum(got[1000 + i]["kept"] for i in range(200)) >= 198
