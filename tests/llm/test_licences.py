import random

from pyspark.sql import functions as F

from urnalake.llm import licences
from urnalake.llm.licence_texts import TEMPLATES


def brute(text):
    """Every unit against every template, no bounds."""
    known = [(name, licences.bigrams(licences.normalised(v))) for name, variants in TEMPLATES.items() for v in variants]

    def best(unit):
        grams = licences.bigrams(licences.normalised(unit))
        scored = [(-licences.dice(grams, t), name) for name, t in known if grams]
        value, name = min(scored, default=(0.0, ""))
        return [(name, -value)] if -value >= licences.LEAST else []

    if not text:
        return []
    found = best(text)
    if found:
        return found
    for paragraph in licences.re.split(r"\n[ \t\r]*\n", text):
        match = best(paragraph)
        if not match and "\n" in paragraph:
            match = [m for line in paragraph.split("\n") for m in best(line)]
        found += match
    return found


def test_equals_brute_force():
    rng = random.Random(1)
    templates = licences.Templates.of(TEMPLATES, licences.LEAST)
    variants = [v for vs in TEMPLATES.values() for v in vs]
    for _ in range(300):
        parts = []
        for _ in range(rng.randint(1, 4)):
            words = rng.choice([*variants, "some other prose that is no licence of any kind"]).split()
            for _ in range(rng.randint(0, max(1, len(words) // 6))):
                words[rng.randrange(len(words))] = rng.choice(["the", "software", "zzz", ""])
            parts.append(" ".join(words))
        text = rng.choice(["\n", "\n\n", "\n \n"]).join(parts)
        assert templates.scan(text) == brute(text)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = licences.op6_licence_scan(spark, sf).collect()
    assert len(rows) == len(texts) and any(r["n_matches"] for r in rows)
    for row in rows:
        expected = sorted(brute(texts[row["doc_id"]]), key=lambda m: (-m[1], m[0]))
        assert row["n_matches"] == len(expected)
        assert (row["licence"], row["dice"]) == (expected[0] if expected else (None, None))


def test_owner_lines_and_layout_do_not_matter():
    templates = licences.Templates.of(TEMPLATES, licences.LEAST)
    mit = TEMPLATES["MIT"][0]
    assert templates.scan(f"Copyright (c) 2020 Some Owner, Inc.\n\n{mit.upper()}") == [("MIT", 1.0)]
    assert templates.scan("ALL RIGHTS   RESERVED") == [("All-Rights-Reserved", 1.0)]
    assert templates.scan("the mit license") == []


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "\n\n\n"), (4, "word " * 50_000), (5, "Released under the MIT License."), (5, "Released under the MIT License.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("licences", F.lit(1)).withColumn("dice", F.lit(2))
    got = [(r["doc_id"], len(r["licences"])) for r in licences.scan_licences(df).collect()]
    assert sorted(got) == [(1, 0), (2, 0), (3, 0), (4, 0), (5, 1), (5, 1)]
    assert licences.scan_licences(df.limit(0)).collect() == []


def _every_window(texts, least, words):
    """(first, last, licence, dice) of all windows that reach the coefficient."""
    known = [(name, licences.bigrams(licences.normalised(v))) for name, vs in texts.items() for v in vs]
    found = []
    for i in range(len(words)):
        for j in range(i + 2, len(words) + 1):
            grams = licences.bigrams(words[i:j])
            found += [(i, j, name, d) for name, t in known if (d := licences.dice(grams, t)) >= least]
    return found


def test_all_windows_are_found():
    rng = random.Random(7)
    texts = {"A": ["a b c d a b e f"], "B": ["b c d a b", "x y"], "C": ["a b a b a b c"], "D": ["one"]}
    matched = 0
    for _ in range(1500):
        words = [rng.choice("abcdefxyz") for _ in range(rng.randint(0, 14))]
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice([v for vs in texts.values() for v in vs]).split()
        least = rng.choice([0.6, 0.75, 0.9])
        got, possible = licences.Windows(texts, least).spans(words), _every_window(texts, least, words)
        assert set(got) <= set(possible)
        assert all(a[1] <= b[0] for a, b in zip(got, got[1:]))
        assert all(any(i < b and a < j for a, b, _, _ in got) for i, j, _, _ in possible)
        alone = licences.Windows({"A": texts["A"]}, least).spans(words)
        best = max((d, j - i, -i) for i, j, _, d in own) if (own := _every_window({"A": texts["A"]}, least, words)) else None
        assert max(((d, j - i, -i) for i, j, _, d in alone), default=None) == best
        matched += len(got)
    assert matched > 1000


PROSE = "Some other prose that is no licence of any kind and goes on for a while. " * 40
PARAGRAPHS = {
    "MIT": ("to the following conditions:", "portions of the Software."),
    "Apache-2.0": ("with the License.", "licenses/LICENSE-2.0"),
    "GPL-3.0": ("any later version.", "for more details."),
}


def _wrapped(text, width=12):
    words = text.split()
    return "\n".join(" ".join(words[i : i + width]) for i in range(0, len(words), width))


def test_licences_of_several_paragraphs_in_long_documents():
    windows = licences.Windows(TEMPLATES, licences.LEAST)
    for name, ends in PARAGRAPHS.items():
        text = " ".join(TEMPLATES[name][0].split())
        for end in ends:
            assert end in text
            text = text.replace(f"{end} ", f"{end}\n\n")
        assert windows.find(f"{PROSE}\n\n{text}\n\n{PROSE}") == [(name, 1.0)]
        assert windows.find(f"{PROSE}\n{_wrapped(TEMPLATES[name][0])}\n{PROSE}") == [(name, 1.0)]


def test_notices_inside_lines_and_beside_owners():
    windows = licences.Windows(TEMPLATES, licences.LEAST)
    line = "The tool is open. Licensed under the Apache License, Version 2.0. See the file beside it for all of the terms"
    assert windows.find(f"{PROSE}{line} {PROSE}") == [("Apache-2.0", 1.0)]
    assert windows.find("words before it. Released under\nthe MIT License. And words after it") == [("MIT", 1.0)]
    assert windows.find("Copyright 2020 Some Owner. All rights reserved.") == [("All-Rights-Reserved", 1.0)]
    both = f"{PROSE} {TEMPLATES['ISC'][0]} Licensed under CC BY-NC 4.0. {TEMPLATES['MIT'][0]} {PROSE}"
    assert windows.find(both) == [("ISC", 1.0), ("CC-BY-NC-4.0", 1.0), ("MIT", 1.0)]
    assert windows.find(PROSE) == windows.find(None) == windows.find("") == []


def test_query_rows_hold_matches_inside_long_texts(spark):
    rows = [(1, f"{PROSE}Released under the MIT License. {PROSE}"), (2, PROSE)]
    got = licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: [m["licence"] for m in r["licences"]] for r in got} == {1: ["MIT"], 2: []}


BSD_2 = """Copyright (c) 2020, Some Owner
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{clause}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
CLAUSE_3 = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def test_exact_copies_of_complete_licences():
    from urnalake.llm import licence_full

    windows = licences.Windows(TEMPLATES, licences.LEAST)
    copies = {
        "BSD-2-Clause": BSD_2.format(clause=""),
        "BSD-3-Clause": BSD_2.format(clause=CLAUSE_3),
        "Apache-2.0": licence_full.APACHE,
        "GPL-3.0": licence_full.GPL,
        "MPL-2.0": licence_full.MPL,
    }
    assert [len(licence_full.APACHE.split()), len(licence_full.GPL.split()), len(licence_full.MPL.split())] == [1581, 5644, 2435]
    for name, copy in copies.items():
        for text in (copy, f"{PROSE}\n\n{copy}\n\n{PROSE}", f"{PROSE}\n{_wrapped(copy, 15)}\n{PROSE}"):
            found = [m for m in windows.find(text) if m[0] != "All-Rights-Reserved"]
            assert {n for n, _ in found} == {name}
        words = licences.normalised(f"{PROSE}\n\n{copy}\n\n{PROSE}")
        (value,) = [d for _, _, n, d in windows.spans(words) if n == name]
        assert value > 0.97
