"""Line rules, licences and languages."""

import random
import re
import textwrap
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyhawk.llm import language_id, licences, line_rules
from tests.llm.frames import ODD_TEXTS, documents, no_documents, odd_documents, words


def plain_counts(text):
    text = text or ""
    own = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(own[i : i + 3]) for i in range(len(own) - 2))
    repeated = set()
    for i in range(len(own) - 2):
        if windows[tuple(own[i : i + 3])] > 1:
            repeated |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(own)
    failed = n < 50 or 100 * len(repeated) > 50 * n
    symbols = sum(c in "#*$%&|<>" for c in text)
    return n, sum(map(len, own)), symbols, len(lines) - len(set(lines)), len(repeated), failed


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_counts_are_those_of_the_definition(spark):
    more = [(20, "a b a b a b a"), (21, "x\ny\nx\n\n x\nx"), (22, "p q r p q r s p q"), (23, f"{words(70)}.\n" * 3)]
    rows = [*ODD_TEXTS, *more]
    got = line_rules.line_cleaning(documents(spark, rows)).collect()
    found = sorted(((r["doc_id"], *(r[c] for c in COUNTS)) for r in got), key=str)
    assert found == sorted(((i, *plain_counts(t)) for i, t in rows), key=str)
    assert not any(r["kept"] for r in got if r["base_failed"])
    assert line_rules.line_cleaning(no_documents(spark)).count() == 0
    assert line_rules.line_cleaning(odd_documents(spark)).count() == len(ODD_TEXTS)


PROSE = "The river ran past the old mill, and nobody had looked at its wheel for years."


@pytest.mark.parametrize(
    "line, fails",
    [
        (PROSE, False),
        ("Licensed under CC BY 4.0.", False),
        ("A first sentence stands here. And a second one was cut off before", False),
        ("no mark of any kind ends this line of words", True),
        ("Home | About | Contact | Imprint | Terms.", True),
        ("Read more", True),
        ("We use cookies to make this site better for you.", True),
        ("THIS LINE IS WRITTEN IN CAPITALS.", True),
        ("Buy!! it!! now!! and!! here.!!", True),
        ("the&&& mill%%% had### no*** wheel.$$$", True),
    ],
)
def test_rules_of_a_line(spark, line, fails):
    df = documents(spark, [(1, line)])
    n = len(line.split())
    assert df.select(line_rules.line_fails(F.col("text"), F.lit(n))).first()[0] is fails


def test_a_text_that_loses_too_much_goes(spark):
    prose = "\n".join(f"{words(20, i)}." for i in range(6))
    junk = "\n".join(f"menu {i} | link {words(4, i)} | more" for i in range(30))
    got = line_rules.line_cleaning(documents(spark, [(1, prose), (2, f"{prose}\n{junk}"), (3, f"{prose}\nHome | News | Login")])).collect()
    by = {r["doc_id"]: r for r in got}
    assert by[1]["kept"] and not by[2]["kept"] and by[3]["kept"]
    assert by[1]["clean_text"] == by[2]["clean_text"] == by[3]["clean_text"] == prose
    assert by[3]["n_words"] - by[3]["n_words_left"] == 5


def plain_dice(unit, template):
    def pairs(text):
        own = re.findall(r"[^\W_]+", text.lower())
        return set(zip(own, own[1:], strict=False))

    a, b = pairs(unit), pairs(template)
    return 2 * len(a & b) / (len(a) + len(b)) if a and b else 0.0


def plain_licences(text):
    units = set()
    for line in (text or "").split("\n"):
        units |= {line, *re.split(r"(?<=[.!?])[\x20\x09-\x0D]+", line)}
    units |= set(re.split(r"\n[\x20\x09-\x0D]*\n", text or ""))
    found = {}
    for unit in units:
        dice, _, name = max((plain_dice(unit, t), -i, name) for i, (name, t) in enumerate(licences.TEMPLATES))
        if dice >= licences.LEAST_DICE:
            found[name] = max(found.get(name, 0), dice)
    return found


def test_licences_are_those_of_brute_force(spark):
    full = next(t for name, t in licences.TEMPLATES if name == "MIT" and len(t) > 200)
    rows = [
        (1, f"{PROSE} Licensed under the Apache License, Version 2.0. {PROSE}"),
        (2, f"Head\n\n{full.replace(', ', ',' + chr(10))}\n\nTail"),
        (3, full.replace("furnished", "given").replace("Software", "Program")),
        (4, "This work is licensed under the GNU General Public License, version 3."),
        (5, "this work was licensed under the gnu general public license version 2"),
        (6, f"{PROSE}\nreleased under THE mit license!\nAll rights reserved."),
        (7, "licensed software under a version of its own"),
        (7, "Licensed under CC BY-NC 4.0."),
        (8, " ".join(["Licensed under CC BY 4.0."] * 50)),
        *ODD_TEXTS,
    ]
    want = {}
    for i, t in rows:
        for name, dice in plain_licences(t).items():
            want[(i, name)] = max(want.get((i, name), 0), dice)
    got = {(r["doc_id"], r["licence"]): r["dice"] for r in licences.licence_scan(documents(spark, rows)).collect()}
    assert got.keys() == want.keys() and len(want) >= 8
    assert all(got[k] == pytest.approx(v) for k, v in want.items())
    assert licences.licence_scan(no_documents(spark)).count() == 0
    assert licences.licence_scan(odd_documents(spark)).count() == 0


def test_statements_that_run_over_lines_are_found(spark):
    texts = dict(licences.TEMPLATES[::-1])
    mit, gpl = (next(t for n, t in licences.TEMPLATES if n == name and len(t) > 200) for name in ("MIT", "GPL-3.0"))
    comment = "\n".join(f" * {x}" for x in textwrap.wrap(gpl, 60))
    header = "\n".join(f"# {x}" for x in textwrap.wrap(mit, 50))
    code = "\n".join(f"    x{i} = call(y{i}, z{i})" for i in range(40))
    rows = [
        (1, f"/*\n * A library for rivers and mills of all kinds.\n *\n{comment}\n *\n * More words.\n */\n{code}"),
        (2, f"{code}\n#\n{header}\n#\n{code}"),
        (3, f"{PROSE} This work is licensed under the GNU\nGeneral Public License, version 3. {PROSE}\n{PROSE}"),
        (4, f"A word before\n{texts['CC0-1.0']}\n{PROSE}"),
        (5, f"{PROSE}\n{PROSE}"),
    ]
    got = {(r["doc_id"], r["licence"]): (r["dice"], r["n_units"]) for r in licences.licence_scan(documents(spark, rows)).collect()}
    assert got == {(1, "GPL-3.0"): (1.0, 1), (2, "MIT"): (1.0, 1), (3, "GPL-3.0"): (1.0, 1), (4, "CC0-1.0"): (1.0, 1)}


@pytest.mark.parametrize(
    "text, licence",
    [
        ("This project is licensed under the MIT License.", "MIT"),
        ("This software is released under the Apache License, Version 2.0.", "Apache-2.0"),
        ("Licensed under CC BY 4.0 by Example Press", "CC-BY-4.0"),
        (f"{PROSE[:-1]}, and the book on it, which is\nlicensed under the MIT license and sold in two towns, says {PROSE}", "MIT"),
        ("The data are licensed under CC BY-SA 4.0, the code is not", "CC-BY-SA-4.0"),
        ("Copyright 2020 Example Press, all rights reserved, printed in Ulm.", "proprietary"),
        ("As of today this work is licensed under the GNU Affero General Public License, version 3, by all its authors", "AGPL-3.0"),
        (f"{PROSE} " + next(t for n, t in licences.TEMPLATES if n == "ISC")[:-1] + " wherever they are", "ISC"),
        ("Photos (c) A. Person. This work is licensed under the GNU General Public License, version 2 - see the file", "GPL-2.0"),
    ],
)
def test_statements_with_other_words_around_them(spark, text, licence):
    got = licences.licence_scan(documents(spark, [(1, text), (1, text), (2, PROSE)])).collect()
    assert [(r["doc_id"], r["licence"], r["n_units"]) for r in got] == [(1, licence, 1)] and got[0]["dice"] >= 0.85


def plain_windows(text):
    own, hits = re.findall(r"[^\W_]+", (text or "").lower()), []
    for t, (name, template) in enumerate(licences.TEMPLATES):
        n, pairs = len(licences._plain_words(template)), licences._plain_words(template)
        pairs = set(zip(pairs, pairs[1:], strict=False))
        found = {i for i in range(len(own) - 1) if (own[i], own[i + 1]) in pairs}
        for i in {min(i, max(len(own) - n, 0)) for i in found}:
            dice = plain_dice(" ".join(own[i : i + n]), template)
            if dice >= licences.LEAST_DICE:
                hits.append((-dice, t, i, min(i + n, len(own)), name))
    beaten = {b for b in hits for a in hits if a < b and a[2] < b[3] and b[2] < a[3]}
    return sorted((name, " ".join(own[low:high]), round(-d, 9)) for d, _, low, high, name in hits if (d, _, low, high, name) not in beaten)


def test_windows_are_those_of_brute_force(spark):
    draw, rows = random.Random(8), []
    for i in range(60):
        own = words(30, 300 + i).split()
        for _ in range(3):
            part = licences._plain_words(draw.choice(licences.TEMPLATES)[1])
            part = [w for w in part if draw.random() > 0.05] + words(draw.randrange(3), i).split()
            at = draw.randrange(len(own))
            own[at:at] = part
        rows.append((i, draw.choice([" ", "\n", ", "]).join(own)))
    rows += [(100, "licensed under the"), (101, "reserved"), (102, None), *((103, x) for x in ("All rights", "all rights reserved") for _ in range(3))]
    df = documents(spark, rows).select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    got = {}
    for r in licences.windows(df, licences.templates(spark), licences.LEAST_DICE).collect():
        got.setdefault(r["id"], []).append((r["licence"], r["unit"], round(r["dice"], 9)))
    want = {i: plain_windows(t) for i, t in rows if plain_windows(t)}
    assert {i: sorted(x) for i, x in got.items()} == want and len(want) > 50


def test_key_words_lose_no_template():
    keys = licences.key_words()
    for _, text in licences.TEMPLATES:
        own = licences._plain_words(text)
        pairs = set(zip(own, own[1:], strict=False))
        without = [p for p in pairs if not set(p) & set(keys)]
        assert len(without) < len(pairs) * licences.LEAST_DICE / (2 - licences.LEAST_DICE)


def test_key_words_are_found_as_whole_words(spark):
    keys = set(licences.key_words())
    texts = ["", None, "LICENSED", "un_under_", "understand", "thunder", "under1", "éunder", "under é", "x\u00a0Under,", "𝒳under", "the—license", "licensee"]
    texts += [*keys, *(f"a{k}" for k in keys), *(f"({k.upper()})" for k in keys), "K" + "under", "\U00010400 license 😀license"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r["id"]: r["x"] for r in df.select("id", licences.may_state(F.coalesce("text", F.lit("")), licences.LEAST_DICE).alias("x")).collect()}
    want = {i: bool(keys & set(licences._plain_words(t or ""))) for i, t in enumerate(texts)}
    # Behind a letter of more than 16 bits a word may be taken for whole: such a text is only compared in vain.
    got.pop(texts.index("𝒳under"))
    assert got.items() <= want.items()


def test_grams_are_those_of_a_plain_count():
    texts = ["Ab a1b", "", "é--é", "x", "  "]
    buckets, owner = language_id.grams(texts)
    for i, text in enumerate(texts):
        folded = re.sub(r"[\W\d_]+", " ", f" {text.lower()} ")
        n = sum(len(folded) - k + 1 for k in (2, 3) if len(folded) >= k) + len(folded.replace(" ", ""))
        assert (owner == i).sum() == n
    again, _ = language_id.grams(["Ab a1b"])
    assert sorted(again) == sorted(buckets[owner == 0])


def test_languages_of_odd_rows(spark):
    rows = [(i, f"{'der und die das' if i % 2 else 'the and of to'} {i}", "de" if i % 2 else "en") for i in range(20)]
    rows += [(30, "und das die", None), (31, "of the", "de"), (32, None, "de"), (33, "123 !", "en"), (None, "to the", "en"), (1, "der die", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    got = language_id.language_id(df, F.col("doc_id") < 30).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[30]["lang_pred"] == "de" and by[31]["lang_pred"] == "en"
    assert by[32]["lang_pred"] == by[33]["lang_pred"] == "und" and by[32]["score"] == 0
    assert by[None]["held_out"] and not by[3]["held_out"] and by[31]["held_out"]
    nothing = language_id.language_id(df, F.lit(False)).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
    assert language_id.language_id(df.limit(0), F.lit(True)).count() == 0


def test_held_out_languages_are_told(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.language_id(df, F.crc32(F.col("doc_id").cast("string")) % 4 != 2).where("held_out").join(df, "doc_id")
    right = got.where("lang = lang_pred").count()
    assert right >= 0.97 * got.count() > 100
