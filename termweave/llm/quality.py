"""Quality rules under weak supervision.

Rules vote good, bad or abstain on measures of a text. How often texts are bad, and how often each
rule votes what on good and on bad texts, is estimated by expectation-maximisation over the counts
of all vote patterns; a text is kept by its posterior probability of being good.

Null and empty texts have no words: every measure is 0, every rule abstains, and the base rule of
ten words rejects them. Repeated rows are measured and counted one by one. Without rows the prior
stands. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termweave.llm import text as T

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_echoes", "n_letters", "n_ended", "n_marked")
#: Fixed characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
RULES = ("symbols", "marked", "letters", "repeats", "dup_lines", "echoes", "word_length", "ended")
GOOD, BAD, NONE = 0, 1, 2

_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))
_CODE = (np.arange(256) & 0xC0) != 0x80
_LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123), *range(0xC0, 256)])
_END = np.isin(np.arange(256), np.frombuffer(b".!?\"')", np.uint8))


def measures(flat: T.Flat) -> dict[str, np.ndarray]:
    """Counts of each text, by the names in BASE and MORE."""
    n = len(flat)
    w, sums = T.words(flat), flat.sums()
    h = T.slice_hash(sums, w.starts, w.ends)
    out = {
        "n_words": w.per_doc(n),
        "word_chars": flat.count((_CODE & ~T.SPACE)[flat.data]),
        "n_symbols": flat.count(_SYMBOL[flat.data]),
        "n_letters": flat.count(_LETTER[flat.data]),
    }
    marks = np.append(0, np.cumsum(_SYMBOL[flat.data], dtype=np.int64))
    out["n_marked"] = np.bincount(w.doc[marks[w.ends] > marks[w.starts]], minlength=n)
    inside = np.zeros(len(flat.data) + 1, np.int64)
    np.cumsum(~T.SPACE[flat.data], out=inside[1:])
    rows = T.lines(flat)
    with_word = inside[rows.ends] > inside[rows.starts]
    rows = T.Spans(rows.starts[with_word], rows.ends[with_word], rows.doc[with_word])
    keys = T.keys_in_doc(T.slice_hash(sums, rows.starts, rows.ends), rows.doc)
    first = np.unique(keys, return_index=True)[1]
    out["n_lines"] = rows.per_doc(n)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(rows.doc[first], minlength=n)
    ended = _END[flat.data[rows.ends - 1]]
    out["n_ended"] = np.bincount(rows.doc[ended], minlength=n)
    same = w.doc[1:] == w.doc[:-1]
    out["n_echoes"] = np.bincount(w.doc[1:][same & (h[1:] == h[:-1])], minlength=n)
    out["n_repeat_words"] = np.bincount(w.doc[repeated_words(h, w.doc, 5)], minlength=n)
    return {c: out[c].astype(np.int64) for c in BASE + MORE}


def repeated_words(h: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
    """Whether each word lies in a run of ``size`` words that its text has twice or more."""
    marks = np.zeros(len(h) + 1, np.int64)
    if len(h) >= size:
        at = np.flatnonzero(doc[size - 1 :] == doc[: len(doc) - size + 1])
        keys = T.keys_in_doc(T.shingles(h, size)[at], doc[at])
        order = np.argsort(keys)
        twin = keys[order][1:] == keys[order][:-1]
        hit = np.zeros(len(at), bool)
        hit[order[1:][twin]] = hit[order[:-1][twin]] = True
        np.add.at(marks, at[hit], 1)
        np.add.at(marks, at[hit] + size, -1)
    return np.cumsum(marks[:-1]) > 0


def measure(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and the measures of each row's text, under the names in BASE and MORE."""
    src = docs.select(*keep, F.col(text).alias("_text"))
    schema = ", ".join(
        [f"`{c}` {src.schema[c].dataType.simpleString()}" for c in keep]
        + [f"{c} long" for c in BASE + MORE]
    )

    def run(batches):
        for batch in T.chunked(batches, "_text"):
            got = measures(T.Flat.of(batch.column("_text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(got[c]) for c in BASE + MORE],
                names=[*keep, *BASE, *MORE],
            )

    return src.mapInArrow(run, schema)


def with_votes(measured: DataFrame) -> DataFrame:
    """Adds a column for each rule: 0 good, 1 bad, 2 abstains."""
    n, c = F.col("n_words"), F.col

    def vote(bad, good):
        return F.when(n == 0, NONE).when(bad, BAD).when(good, GOOD).otherwise(NONE)

    rules = {
        "symbols": vote(c("n_symbols") * 10 > n, c("n_symbols") * 50 <= n),
        "marked": vote(c("n_marked") * 10 > n, c("n_marked") * 50 <= n),
        "letters": vote(
            c("n_letters") * 100 < c("word_chars") * 90, c("n_letters") * 100 >= c("word_chars") * 94
        ),
        "repeats": vote(F.lit(False), c("n_repeat_words") * 20 <= n),
        "dup_lines": vote(c("n_dup_lines") * 3 > c("n_lines"), F.lit(False)),
        "echoes": vote(c("n_echoes") * 10 > n, c("n_echoes") * 50 <= n),
        "word_length": vote(
            (c("word_chars") < n * 2) | (c("word_chars") > n * 20),
            (c("word_chars") >= n * 3) & (c("word_chars") <= n * 12),
        ),
        "ended": vote(c("n_ended") * 4 < c("n_lines"), c("n_ended") * 2 >= c("n_lines")),
    }
    return measured.withColumns({f"vote_{k}": v.cast("int") for k, v in rules.items()})


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def learn(counts: dict[tuple[int, ...], int], rounds: int = 50) -> tuple[float, np.ndarray]:
    """Share of bad texts, and P(vote | class) as classes x rules x votes.

    Beta-like counts keep every rule better than chance: a rule votes for a text's own class four
    times as often as against it before any text is seen.
    """
    patterns = np.array(list(counts) or [(NONE,) * len(RULES)], np.int64)
    weight = np.array(list(counts.values()) or [0], float)
    hot = np.eye(3)[patterns]  # patterns x rules x votes
    prior = np.array([[4.0, 1.0, 1.0], [1.0, 4.0, 1.0]])[:, None, :] * np.ones((2, len(RULES), 1))
    # ten texts' worth, or one in a thousand of the texts: it doesn't fade as texts are added
    prior *= max(10.0, 1e-3 * weight.sum())
    bad, chance = 0.2, prior / prior.sum(2, keepdims=True)
    for _ in range(rounds):
        p = posterior(hot, bad, chance)
        share = np.stack([p, 1 - p]) * weight  # good, bad
        chance = np.einsum("cp,prv->crv", share, hot) + prior
        chance /= chance.sum(2, keepdims=True)
        bad = float((share[1].sum() + 2) / (weight.sum() + 10))
    return bad, chance


def posterior(hot: np.ndarray, bad: float, chance: np.ndarray) -> np.ndarray:
    """Probability of being good."""
    log = np.einsum("prv,crv->cp", hot, np.log(chance)) + np.log([[1 - bad], [bad]])
    return 1 / (1 + np.exp(np.clip(log[1] - log[0], -500, 500)))


def fit(voted: DataFrame) -> tuple[float, np.ndarray]:
    """Learns from the counts of vote patterns: 3 ** rules numbers at most.

    Every row counts that the base rule leaves to decide.
    """
    votes = [f"vote_{r}" for r in RULES]
    rows = voted.where(~base_failed()).groupBy(*votes).count().collect()
    return learn({tuple(r[v] for v in votes): r["count"] for r in rows})


def with_verdict(voted: DataFrame, model: tuple[float, np.ndarray], least: float = 0.5) -> DataFrame:
    """Adds p_good, base_failed and kept; the log odds of a class are sums over the rules."""
    bad, chance = model
    odds = F.lit(float(np.log(bad / (1 - bad))))
    step = np.log(chance[1]) - np.log(chance[0])
    for k, rule in enumerate(RULES):
        table = F.array(*[F.lit(float(x)) for x in step[k]])
        odds = odds + F.element_at(table, F.col(f"vote_{rule}") + 1)
    return (
        voted.withColumn("p_good", 1 / (1 + F.exp(odds)))
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= least))
    )


def judged(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The kept columns, measures, votes, p_good, base_failed and kept, a row for each row."""
    voted = with_votes(measure(docs, text, keep))
    return with_verdict(voted, fit(voted))
