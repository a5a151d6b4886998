import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from termweave.llm import quality as Q
from termweave.llm.text import Flat


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    inside = {k + j for k in range(len(w) - 4) if windows[tuple(w[k : k + 5])] > 1 for j in range(5)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(inside)


@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n#é|", max_size=80)), max_size=6))
@settings(max_examples=80, deadline=None)
def test_measures(texts):
    got = Q.measures(Flat.of(pa.array(texts, pa.string())))
    assert list(zip(*(got[c].tolist() for c in Q.BASE), strict=True)) == [brute(t) for t in texts]


def test_em_tells_junk_from_text_without_labels():
    r = np.random.default_rng(2)
    bad = r.random(4000) < 0.15
    votes = np.full((4000, len(Q.RULES)), Q.GOOD)
    for k, (hit, false) in enumerate([(0.9, 0.02), (0.8, 0.05), (0.9, 0.01)]):
        votes[:, k] = np.where(r.random(4000) < np.where(bad, hit, false), Q.BAD, Q.GOOD)
    votes[:, 3:] = np.where(r.random((4000, len(Q.RULES) - 3)) < 0.3, Q.NONE, Q.GOOD)
    share, chance = Q.learn(Counter(map(tuple, votes.tolist())))
    good = Q.posterior(np.eye(3)[votes], share, chance)
    assert abs(share - 0.15) < 0.04
    assert ((good < 0.5) == bad).mean() > 0.97


def test_verdicts(documents):
    rows = [(k, f"w{k} some plain words here that end as they should, and word{k} more of them.") for k in range(900)]
    rows += [(1000 + k, " ".join(f"a{j}%%% b{k}&&& c###" for j in range(20))) for k in range(90)]
    rows += [(2000, None), (2001, ""), (2002, "too short"), (2003, "x y z a b " * 40), (2004, "word" * 50_000), (0, rows[0][1]), (None, rows[1][1])]
    got = Q.judged(documents(rows)).collect()
    assert len(got) == len(rows)
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert all(kept[k] for k in [*range(900), None]) and not any(kept[1000 + k] for k in range(90))
    assert not any(kept[k] for k in range(2000, 2005))
    assert {r["doc_id"] for r in got if r["base_failed"]} == set(range(2000, 2005))
    assert Q.judged(documents([])).collect() == []
