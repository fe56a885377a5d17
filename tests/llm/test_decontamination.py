import hashlib

import numpy as np
import pytest
from llm_cases import ROWS, alnum, benchmark_hits, documents, frame, rows

from orderlens.llm import decontamination
from orderlens.llm.common import ALNUM, Words


def setup():
    items = rows("benchmark", "item_id, text")
    items += [(9001, "the of"), (9002, "the THE the"), (9003, ""), (9004, None), (9005, "seven eight nine"), (900, items[0][1])]
    docs = [*documents(), *ROWS, (-5, items[3][1] + " x " + items[3][1]), (-5, items[3][1]), (-5, items[3][1]), (-6, "the the of the the")]
    return docs, items


@pytest.mark.parametrize("windows", [decontamination.BROADCAST_WINDOWS, 0])
def test_equals_brute_force(spark, monkeypatch, windows):
    """With the benchmark broadcast, and joined by its fingerprints."""
    docs, items = setup()
    plain = decontamination.contaminated_spans
    monkeypatch.setattr(decontamination, "contaminated_spans", lambda d, b: plain(d, b, windows))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contamination(frame(spark, docs, ["spans", "n_words"]), benchmark).collect()
    expected = [
        (str(d), n, hit, len(of), hashlib.sha256(",".join(of).encode()).hexdigest(), hit > 0)
        for d, n, hit, of in benchmark_hits(docs, items)
    ]
    assert sorted((str(r[0]), *r[1:]) for r in map(tuple, got)) == sorted(expected)


def test_a_shared_window_always_shares_its_fingerprint():
    def prints(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return decontamination.fingerprints(Words(data, np.array([0, len(data)]), ALNUM).hashes())

    words = alnum(documents()[0][1])[:60]
    for at in range(40):
        shared = " ".join(words[at : at + 10])
        assert prints(shared)[0] in prints(f"x y {shared} z") and prints(shared)[0] in prints(" ".join(words))


@pytest.mark.parametrize("windows", [decontamination.BROADCAST_WINDOWS, 0])
def test_clean_documents_keeps_rows_and_columns(spark, monkeypatch, windows):
    plain = decontamination.contaminated_spans
    monkeypatch.setattr(decontamination, "contaminated_spans", lambda d, b: plain(d, b, windows))
    docs, items = setup()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    df = frame(spark, docs, ["text_key", "spans"])
    kept = decontamination.clean_documents(df, benchmark)
    assert kept.columns == df.columns
    clean = [(str(d), t) for (d, t), hit in zip(docs, benchmark_hits(docs, items), strict=True) if not hit[2]]
    assert sorted((str(r[0]), str(r[1])) for r in kept.collect()) == sorted((d, str(t)) for d, t in clean)


def test_both_ways_give_the_same_spans(spark):
    docs, items = setup()
    docs, benchmark = frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    def spans(windows):
        rows = decontamination.contaminated_spans(docs, benchmark, windows).collect()
        return sorted(str((r["doc_id"], r["n_words"], r["spans"], sorted(map(str, r["item_ids"])))) for r in rows)
    assert spans(decontamination.BROADCAST_WINDOWS) == spans(0)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    result = decontamination.contamination(frame(spark, ROWS), none).collect()
    assert len(result) == len(ROWS) and not any(r["contaminated"] for r in result)
    assert decontamination.contamination(frame(spark, []), none).collect() == []
