import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from conftest import SF_SMALL
from llm_cases import documents, no_documents

from strata.llm import licenses as L


def grams(text):
    w = re.findall(r"[a-z0-9\x80-\U0010ffff]+", text.lower())
    return [(a, b) for a, b in zip(w, w[1:])]


TEMPLATES = {n: Counter(grams(t)) for n, t in L.TEMPLATES.items()}
KNOWN = set().union(*TEMPLATES.values())
NAMING = {n: {g for g in t if not set(g) <= L.GENERIC} if sum(t.values()) <= L.SHORT else set() for n, t in TEMPLATES.items()}


def best(unit):
    """Every template compared, without size bounds."""
    own, n, found = Counter(unit), len(unit), None
    for name, t in sorted(TEMPLATES.items()):
        dice = 2 * sum((own & t).values()) / (n + sum(t.values())) if n else 0
        if dice >= L.MIN_DICE and (found is None or dice > found[0]) and NAMING[name] <= set(own):
            found = dice, name
    return found


def brute_force(text):
    lines = [x for x in (text or "").split("\n") if re.search(r"[a-z0-9\x80-\U0010ffff]", x.lower())]
    looks = [bool(grams(x)) and sum(g in KNOWN for g in grams(x)) >= L.LOOK * len(grams(x)) for x in lines]
    units, k = [], 0
    while k < len(lines):
        if looks[k]:
            end = k
            while end < len(lines) and looks[end]:
                end += 1
            units += [(i, grams(lines[i])) for i in range(k, end)]
            if end - k > 1:
                units.append((k, grams("\n".join(lines[k:end]))))
            k = end
        else:
            k += 1
    whole = grams(text or "")
    if units and sum(g in KNOWN for g in whole) >= L.LOOK * len(whole):
        units.append((0, whole))
    out = {}
    for at, unit in units:
        hit = best(unit)
        if hit:
            out.setdefault(hit[1], []).append((hit[0], at))
    return {name: (round(max(d for d, _ in hits), 9), len({a for _, a in hits})) for name, hits in out.items()}


def wrapped(text, width):
    w = text.split()
    return "\n".join(" ".join(w[i : i + width]) for i in range(0, len(w), width))


def test_matches_equal_brute_force(spark):
    mit, bsd = L.TEMPLATES["MIT"], L.TEMPLATES["BSD-2-Clause"]
    rows = [
        (1, mit), (2, "Copyright (c) 2031 Someone\n\n" + wrapped(mit, 9) + "\n\nint main() {}\n"), (3, wrapped(bsd, 12).replace("source", "sauce")),
        (4, "prose first\nReleased under the MIT license!\nprose\nLicensed under CC BY-NC 4.0"), (5, mit[: len(mit) // 3]), (6, None), (7, ""), (8, "Released"),
        (9, "Released under the MIT License."), (9, "Released under the MIT License."),
    ]
    own = spark.createDataFrame(rows, "doc_id long, text string")
    for docs in (own, documents(spark, SF_SMALL)):
        expected = sorted((r["doc_id"], name, *v) for r in docs.collect() for name, v in brute_force(r["text"]).items())
        got = sorted((r["doc_id"], r["license"], round(r["dice"], 9), r["n_units"]) for r in L.scan_licenses(docs).collect())
        assert got == expected
        assert len(got) >= 3
    assert {1, 2, 3, 4, 9} <= {r["doc_id"] for r in L.scan_licenses(own).collect()}


def test_every_notice_line_of_the_given_table_is_found(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    lines = {(r["doc_id"], n) for r in docs.collect() for n, t in L.TEMPLATES.items() if any(x == t for x in r["text"].split("\n"))}
    assert lines and lines <= {(r["doc_id"], r["license"]) for r in L.scan_licenses(docs).collect()}


def test_empty_table_and_no_templates(spark):
    assert L.scan_licenses(no_documents(spark)).count() == 0
    assert L.scan_licenses(documents(spark, SF_SMALL), {}).count() == 0


def test_notice_inside_a_line_and_licences_one_after_the_other(spark):
    mit, bsd = L.TEMPLATES["MIT"], L.TEMPLATES["BSD-2-Clause"]
    rows = [
        (1, "The weights and the code in this archive were prepared by the team. Released under the MIT License. See the docs."),
        (2, wrapped(mit, 9) + "\n\n" + wrapped(bsd, 11)), (3, "one " * 50 + mit + " two" * 50 + " " + mit), (4, "Released under the\n\nMIT License"),
        (5, "under the MIT"),
    ]
    got = L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["license"], r["dice"], r["n_units"]) for r in got} == {
        (1, "MIT notice", 1.0, 1), (2, "MIT", 1.0, 1), (2, "BSD-2-Clause", 1.0, 1), (3, "MIT", 1.0, 2), (4, "MIT notice", 1.0, 1),
    }


def test_windows_equal_all_windows(monkeypatch):
    monkeypatch.setattr(L, "GENERIC", {f"w{k}" for k in range(9)})  # the coefficient alone
    rng = random.Random(6)
    text = lambda n, m: [f"w{rng.randrange(m)}" for _ in range(n)]
    few = {f"t{k}": " ".join(text(rng.randrange(2, 16), 5)) for k in range(6)}
    held, found = L.Templates(few), 0
    for _ in range(60):
        texts = [" ".join(sum((rng.choice([text(3, 9), few[rng.choice(list(few))].split()]) for _ in range(rng.randrange(6))), [])) for _ in range(3)]
        words, hashes = L.tokens(pa.array(texts))
        of = words.doc()
        got = {}
        for k, a, b, dice in L.windows(L.bigrams(hashes), np.where(of[1:] == of[:-1], of[:-1], -1), held):
            assert of[a] == of[b + 1]
            got[int(of[a]), held.names[k]] = max(got.get((int(of[a]), held.names[k]), 0), dice)
        expected = {}
        for d, t in enumerate(texts):
            g = grams(t)
            for name, template in few.items():
                own = Counter(grams(template))
                dice = max((2 * sum((Counter(g[a:b]) & own).values()) / (b - a + sum(own.values())) for a in range(len(g)) for b in range(a + 1, len(g) + 1)), default=0)
                if dice >= L.MIN_DICE:
                    expected[d, name] = dice
        assert got == expected
        found += len(got)
    assert found > 100


def test_near_relatives_have_names_of_their_own(spark):
    gpl2 = L.TEMPLATES["GPL-3.0 header"].replace("version 3", "version 2").replace("software: you", "software; you")
    rows = {
        "GPL-2.0 header with link": gpl2,
        "LGPL-3.0 header": L.TEMPLATES["GPL-3.0 header"].replace("General Public", "Lesser General Public"),
        "GPL-2.0 notice": "This work is licensed under the GNU General Public License, version 2.",
        "BSD-3-Clause": wrapped(L.TEMPLATES["BSD-3-Clause"], 10),
        "MPL-2.0 header": wrapped(L.TEMPLATES["MPL-2.0 header"], 10),
        "Unlicense": L.TEMPLATES["Unlicense"],
        **{n: "Some words before.\n" + L.TEMPLATES[n] + "\nand after" for n in L.FULL_TEXTS},
    }
    docs = spark.createDataFrame(list(enumerate(rows.values())), "doc_id long, text string")
    got = {}
    for r in L.scan_licenses(docs).collect():
        got.setdefault(r["doc_id"], {})[r["license"]] = r["dice"]
    for k, name in enumerate(rows):
        assert got[k][name] == 1.0
        # A full text may quote the header that it recommends, but is no other full text.
        assert len(set(got[k]) & ({*L.FULL_TEXTS} if name in L.FULL_TEXTS else {*rows})) == 1, (name, got[k])
    assert not L.scan_licenses(spark.createDataFrame([(1, "SPDX-License-Identifier: Zlib")], "doc_id long, text string")).count()


def test_other_licences_are_not_taken_for_a_short_notice(spark):
    rows = [
        "This project is licensed under the Zebra Public License.", "This project is licensed under the ISC License.",
        "This work is licensed under the GNU Free Documentation License.", "Released under the Zlib License.", "Licensed under the BSD 4-Clause License.",
        "Licensed under the Zebra License, Version 2.0.", "This software is licensed under the terms of its owner.", "Licensed under CC BY-NC 3.0.",
        "prose before it. This project is licensed under the Zebra Public License. and prose after it", "SPDX-License-Identifier: MPL-1.1",
    ]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert L.scan_licenses(docs).collect() == []
    # A version that is not the template's is no match of that template.
    other = spark.createDataFrame([(1, "This library is licensed under the GNU Lesser General Public License, version 2.")], "doc_id long, text string")
    assert "LGPL-2.1 notice" not in {r["license"] for r in L.scan_licenses(other).collect()}
    same = spark.createDataFrame([(1, "This software is licensed under the MIT License"), (2, "this package is released under the mit license.")], "doc_id long, text string")
    assert {r["doc_id"] for r in L.scan_licenses(same).collect()} == {1, 2}
