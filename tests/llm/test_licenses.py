import pytest
from llm_cases import ROWS, alnum, documents, frame

from orderlens.llm import licenses

NOTICES = [
    "Released under the MIT License. Under The MIT license!",
    "apache license, version 2.0 and Apache License version 2 and apache license version 20",
    "CC-BY-NC cc by nc by nc xcc by nc", "All rights reserved.",
    "// SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0\nGNU General Public License",
    "SPDX-License-Identifier: mit and\nSPDX-License-Identifier:BSD-3-Clause", "SPDX-License-Identifier:",
]


def brute(text):
    w = alnum(text)
    places, labels = [], set()
    for phrase, label in licenses.BASE_PHRASES.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_columns(spark):
    docs = [*documents(), *ROWS, *((500 + i, t) for i, t in enumerate(NOTICES))]
    result = licenses.scan_documents(frame(spark, docs, ["labels", "score"])).collect()
    expected = sorted((str(d), *map(str, brute(t))) for d, t in docs)
    got = sorted(tuple(map(str, (r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]))) for r in result)
    assert got == expected
    for r in result:
        assert 0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert (r["score"] > 0) == (r["labels"] != "")


def test_labels_of_the_method(spark):
    rows = licenses.scan_documents(frame(spark, list(enumerate(NOTICES)))).collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[3]["labels"] == "proprietary" and by_id[3]["permitted"] is False
    assert by_id[4]["labels"] == "apache-2,gpl,mit" and by_id[4]["permitted"] is True
    assert by_id[4]["expressions"] == ["(mit or gpl-2.0-only) and apache-2.0"]
    assert by_id[5]["labels"] == "bsd,mit"
    assert by_id[6]["labels"] == "" and by_id[6]["permitted"] is None


@pytest.mark.parametrize(("expression", "order", "permitted"), [
    ("mit", ["mit"], True),
    ("mit or gpl-3.0", ["mit", "gpl-3.0", "or"], True),
    ("mit and gpl-3.0", ["mit", "gpl-3.0", "and"], False),
    ("a or mit and b", ["a", "mit", "b", "and", "or"], False),
    ("(gpl-2.0 or mit) and bsd-3-clause", ["gpl-2.0", "mit", "or", "bsd-3-clause", "and"], True),
    ("apache-2.0 with llvm-exception", ["apache-2.0", "llvm-exception", "with"], True),
    ("(mit", None, False), ("mit)", None, False), ("mit mit", None, False), ("or", None, False), ("", None, False),
])
def test_expressions(expression, order, permitted):
    assert licenses.postfix(expression) == order
    assert licenses.permits(expression) is permitted


@pytest.mark.parametrize(("identifier", "label", "permitted"), [
    ("cc-by-4.0", "cc-by", True), ("cc-by-sa-4.0", "cc-by-sa", False), ("cc-by-nd-4.0", "cc-by-nd", False), ("cc-by-nc-4.0", "cc-by-nc", False),
    ("cc-by-nc-sa-3.0", "cc-by-nc-sa", False), ("cc-by-nc-nd-2.5", "cc-by-nc-nd", False), ("cc0-1.0", "cc0", True), ("mit-0", "mit-0", True),
    ("mit", "mit", True), ("mit-modern-variant", "mit", True), ("mitx", "mitx", False), ("apache-2.0", "apache-2", True), ("apache-2.0+", "apache-2", True),
    ("apache-1.1", "apache-1", True), ("bsd-3-clause", "bsd", True), ("0bsd", "0bsd", True), ("bsl-1.0", "bsl", True), ("busl-1.1", "busl", False),
    ("gpl-2.0-only", "gpl", False), ("lgpl-3.0-or-later", "lgpl", False), ("agpl-3.0+", "agpl", False), ("mpl-2.0", "mpl", True),
    ("cecill-b", "cecill-b", True), ("cecill-2.1", "cecill", False), ("none", "none", False), ("licenseref-own", "licenseref-own", False),
])
def test_families(identifier, label, permitted):
    assert licenses.family(identifier) == label
    assert licenses.permits(identifier) is permitted


def test_every_family_is_its_own_and_permitted_ones_are_families():
    assert all(licenses.family(f) == f == licenses.family(f"{f}-9.9") for f in licenses.FAMILIES if f not in ("apache", "mit"))
    assert licenses.PERMITTED <= set(licenses.FAMILIES) and len(set(licenses.FAMILIES)) == len(licenses.FAMILIES)
    notices = set(licenses.NOTICE_PHRASES.values()) | set(licenses.creative_commons().values())
    assert notices - {"proprietary"} <= set(licenses.FAMILIES)


def test_every_notice_is_found_and_the_longest_counts(spark):
    phrases = licenses.NOTICE_PHRASES | licenses.creative_commons()
    docs = [(i, f"x {phrase.title()}, y") for i, phrase in enumerate(phrases)]
    got = {r["doc_id"]: r for r in licenses.scan_documents(frame(spark, docs)).collect()}
    for i, (phrase, label) in enumerate(phrases.items()):
        base = {b for p, b in licenses.BASE_PHRASES.items() if f" {p} " in f" {phrase} "}
        assert got[i]["labels"] == ",".join(sorted({label, *base})), phrase
        assert got[i]["permitted"] is ({label, *base} <= licenses.PERMITTED), phrase


@pytest.mark.parametrize(("text", "labels"), [
    ("Creative Commons Attribution-NonCommercial-NoDerivs 3.0", "cc-by-nc-nd"), ("Creative Commons Attribution-ShareAlike 4.0", "cc-by-sa"),
    ("Creative Commons Attribution 4.0 and GNU Lesser General Public License", "cc-by,lgpl"), ("Apache License", "apache"),
    ("Creative Commons Attribution Non-Commercial Share Alike", "cc-by-nc-sa"), ("cc by nc nd", "cc-by-nc,cc-by-nc-nd"),
])
def test_overlapping_notices(spark, text, labels):
    assert licenses.scan_documents(frame(spark, [(1, text)])).first()["labels"] == labels


def test_permitted_is_a_parameter_and_exceptions_must_be_known(spark):
    docs = [(1, "SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0"), (2, "SPDX-License-Identifier: MIT WITH No-Evil")]
    def verdicts(**options):
        return [r["permitted"] for r in licenses.scan_documents(frame(spark, docs), **options).orderBy("doc_id").collect()]
    assert verdicts() == [False, False] and verdicts(permitted=["gpl"]) == [True, False]


def test_empty_table(spark):
    assert licenses.scan_documents(frame(spark, [])).collect() == []
