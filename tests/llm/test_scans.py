"""Quality, personal data and license operators against plain versions and held-out labels."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm.license_scan import PHRASES, TEMPLATES, lower_words, order_templates, scan_licenses
from tessera.llm.pii import KINDS, find_personal_data, redact_personal_data
from tessera.llm.quality_classifier import classify_quality, keep_good_documents, train_quality
from tessera.llm.quality_rules import RULES, estimate_votes, quality_rules
from tessera.llm.text_stats import n_repeat_words, words

WORD = r"[^\x20\x09-\x0D]+"


def base_counts(t):
    t = t or ""
    found = re.findall(WORD, t)
    lines = [x for x in t.split("\n") if re.search(WORD, x)]
    windows = defaultdict(list)
    for i in range(len(found) - 7):
        windows[tuple(found[i:i + 8])].append(i)
    covered = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(8)}
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def repeating_texts():
    rnd = random.Random(9)
    out = [" ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 60))) for _ in range(60)]
    phrase = "one two three four five six seven eight nine".split()
    out += [" ".join(phrase * k + [str(k)] + phrase[:j]) for k in range(4) for j in range(10)]
    return list(enumerate(out, 100))


def test_quality_counts_match_brute_force(spark, odd_docs, odd_rows):
    more = repeating_texts()
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id bigint, text string"))
    rows = quality_rules(docs).collect()
    want = sorted(((i, *base_counts(t)) for i, t in odd_rows + more), key=repr)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows), key=repr) == want
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert 0 <= r.quality <= 1 and not (r.base_failed and r.kept)


def test_repeated_windows_of_one_long_text(spark):
    t = " ".join(f"w{n % 500}" for n in range(20_000))
    df = spark.createDataFrame([(t,)], "text string").select(n_repeat_words(words(F.col("text"))).alias("n"))
    assert df.first().n == 20_000


def test_votes_find_faults_that_few_rules_see():
    rnd = random.Random(1)
    patterns = Counter()
    truth = Counter()
    for _ in range(20_000):
        good = rnd.random() < 0.85
        kind = rnd.randrange(4)
        votes = tuple(
            (-1 if rnd.random() < 0.0005 else 0) if good else (-1 if k % 4 == kind and rnd.random() < 0.9 else 0) for k in range(8))
        patterns[votes] += 1
        truth[votes, good] += 1
    model = estimate_votes(patterns, 8)
    wrong = sum(n for (votes, good), n in truth.items() if good != (model.log_odds(votes) > 0))
    assert wrong < 0.02 * 20_000 and 0.8 < model.good < 0.9


def test_votes_without_texts_keep_the_start():
    assert estimate_votes({}, len(RULES)).good == 0.8


def test_quality_rules_on_the_documents(spark, sf_dir):
    kept = {r.doc_id: (r.kept, r.base_failed) for r in quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    clean = [r.doc_id for r in labels if r.quality == 1 and not kept[r.doc_id][1]]
    junk = [r.doc_id for r in labels if r.quality == 0]
    assert sum(kept[i][0] for i in clean) >= 0.97 * len(clean)
    assert sum(not kept[i][0] for i in junk) >= 0.8 * len(junk)


def test_quality_rules_of_no_rows(no_docs):
    assert quality_rules(no_docs).collect() == []


def test_classifier_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scored = {r.doc_id: r for r in classify_quality(docs, labels).collect()}
    assert len(scored) == docs.count()
    import zlib

    for i, r in scored.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(scored[r.doc_id].score, r.quality) for r in labels.collect() if scored[r.doc_id].held_out]
    ones, zeros = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    auc = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / (len(ones) * len(zeros))
    assert auc > 0.97


def test_classifier_learns_from_rows_in_the_fold_only(spark, sf_dir):
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    lied = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert train_quality(docs, labels) == train_quality(docs, lied)


def test_classifier_of_odd_rows_and_labels(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame(
        [(4, 1), (4, 1), (11, 0), (None, 1), (8, None), (14, 7), (12, 0), (16, 1), (17, 1), (10, 0)], "doc_id bigint, quality int")
    rows = classify_quality(odd_docs, labels).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    assert all(not r.held_out for r in rows if r.doc_id is None)
    one_class = classify_quality(odd_docs, labels.where("quality = 1")).collect()
    assert len({r.score for r in one_class}) == 1
    assert keep_good_documents(odd_docs, labels).columns == odd_docs.columns
    assert classify_quality(no_docs, labels).collect() == []
    nothing = labels.where("false")
    assert len(classify_quality(odd_docs, nothing).collect()) == len(odd_rows)


def base_spans(t):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m.group())
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        if 16 <= len(digits) <= 19 and sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (KINDS.index(s[0]), s[1]))


def personal_texts():
    rnd = random.Random(7)
    parts = ["a@b.c", "x_y@mail7.example.com", "a@b", "é", "😀", "10.0.0.1", "256.1.1.1", "1.2.3.4.5.6.7.8", "001.02.3.0255", "..",
             "4111 1111 1111 1111", "4111-1111-1111-1112", "4111111111111111", "+1 (017) 555-7713", "+49 30 1234567", "+12", "@", "+",
             " ", ",", "\n", "-", ".", "7", "word", "_", "%"]
    out = ["".join(rnd.choice(parts) + rnd.choice(["", " ", " "]) for _ in range(rnd.randint(0, 14))) for _ in range(400)]
    out += ["1" * 4000 + "." + "2" * 50 + " " + "a." * 2000 + "@x.y 000.000.000.000 " + "1 " * 3000, "+" * 3000 + "+1 " + "2" * 12]
    return list(enumerate(out, 1000))


def as_text(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_personal_data_matches_plain_patterns(spark, odd_docs, odd_rows):
    more = personal_texts()
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id bigint, text string"))
    rows = find_personal_data(docs).collect()
    assert len(rows) == len(odd_rows) + len(more)
    texts = dict(odd_rows + more)
    for r in rows:
        base = base_spans(texts[r.doc_id] or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in KINDS]
        assert r.base_sha256 == hashlib.sha256(as_text(base).encode()).hexdigest()
        assert set(filter(None, as_text(base).split(","))) <= set(r.spans.split(","))


def test_contexts_discover_numbers_that_the_patterns_miss(spark):
    def luhn(n):
        body = f"{n:015d}"
        total = sum(x - 9 if x > 9 else x for x in (int(c) * (2 - i % 2) for i, c in enumerate(body)))
        return body + str(-total % 10)

    seeds = [(k, f"some words then {luhn(4 * 10**14 + 7919 * k)} and more") for k in range(60)]
    other = [(1000, "again 4000000000000000 here"), (1001, "in version 3.0 of 2024")]
    rows = {r.doc_id: r for r in find_personal_data(spark.createDataFrame(seeds + other, "doc_id bigint, text string")).collect()}
    assert all(rows[k].n_card == 1 for k in range(60))
    assert rows[1000].n_card == 0 and rows[1000].spans == "card:6:22"
    assert rows[1001].spans == ""


def test_redaction_leaves_no_match_and_no_other_change(spark, odd_docs):
    texts = personal_texts()
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id bigint, text string, spans string")
    rows = redact_personal_data(docs)
    assert rows.columns == docs.columns
    for r in rows.collect():
        assert base_spans(r.text) == [] and r.spans == "x"
        if not base_spans(dict(texts)[r.doc_id]):
            assert r.text == dict(texts)[r.doc_id] or "[" in r.text
    same = redact_personal_data(odd_docs)
    assert sorted(map(repr, same.collect())) == sorted(map(repr, odd_docs.collect()))


def test_running_folds_blocks_alike(spark):
    from itertools import accumulate

    from tessera.llm.pii import FOLD, running

    for n in (0, 1, FOLD, FOLD + 1, 3 * FOLD + 7):
        values = [(k * 7919) % 101 - 30 for k in range(n)]
        df = spark.createDataFrame([(values,)], "v array<int>")
        for merge, plain in ((lambda a, b: a + b, lambda a, b: a + b), (F.greatest, max)):
            got = df.select(running(F.col("v"), "int", merge, F.lit(0)).alias("r")).first().r
            assert got == list(accumulate(values, plain, initial=0))[:-1]


def test_a_long_table_of_numbers_is_one_pass(spark):
    parts = [f"10.{k % 256}.{k // 256}.7" if k % 3 else f"{k * 7919 % 100003}.{k % 13}" for k in range(60_000)]
    text = "é😀 " + " ".join(parts)
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    found = find_personal_data(docs).first()
    base = base_spans(text)
    assert found.n_ip == len(base) == 40_000 and found.base_sha256 == hashlib.sha256(as_text(base).encode()).hexdigest()
    assert redact_personal_data(docs).first().text == "é😀 " + " ".join("[ip]" if k % 3 else p for k, p in enumerate(parts))


def test_personal_data_of_no_rows(no_docs):
    assert find_personal_data(no_docs).collect() == [] and redact_personal_data(no_docs).collect() == []


def license_texts():
    rnd = random.Random(5)
    vocabulary = sorted({w for _, t in TEMPLATES for w in lower_words(t)}) + ["other", "words", "é", "字"]
    out = ["Released UNDER the MIT License", "under the mit license under the mit license", "apache license, version 2.0", "CC-BY/NC", ""]
    for _, template in TEMPLATES:
        found = template.split()
        out += [template, " ".join(found[:-1]), "before " + template + " after\nnext line", " ".join(reversed(found))]
    out += [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 200))) for _ in range(150)]
    return list(enumerate(out, 500))


def test_licenses_match_brute_force(spark, odd_docs, odd_rows):
    texts = license_texts()
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(texts, "doc_id bigint, text string"))
    rows = scan_licenses(docs).collect()
    every = dict(odd_rows + texts)
    assert len(rows) == len(odd_rows) + len(texts)
    for r in rows:
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in every[r.doc_id] or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
        places = [(i, label) for p, label in PHRASES for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        starts = [i for i, _ in places]
        base = {label for _, label in places}
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(places), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted(base))
        # every block against every template, without filters
        best = {}
        for line in t.split("\n"):
            have = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", line)
            for start in range(0, max(1, len(have) - 32), 32):
                for label, template in TEMPLATES:
                    need = set(lower_words(template))
                    share = len(need & set(have[start:start + 64])) / len(need)
                    if 1000 * len(need & set(have[start:start + 64])) >= 850 * len(need):
                        best[label] = max(share, best.get(label, 0))
        assert r.candidate_labels == ",".join(sorted(base | set(best)))
        assert base <= set(filter(None, r.labels.split(","))) <= base | set(best)
        assert r.score == pytest.approx(1.0 if base else max(best.values(), default=0.0))


def test_template_prefixes_hold_a_word_of_every_match():
    for template in order_templates(TEMPLATES, {"the": 10**6, "license": 5}):
        assert len(template.prefix) == len(template.words) - template.needed + 1
        assert template.words.index("the") == len(template.words) - 1 if "the" in template.words else True


def test_licenses_of_no_rows(no_docs):
    assert scan_licenses(no_docs).collect() == []


def test_wrapped_notices_are_found_at_every_start(spark):
    texts, want = [], {}
    width = max(len(lower_words(t)) for _, t in TEMPLATES)
    for label, template in TEMPLATES:
        for before in range(0, 100, 3):
            found = ("z " * before + template + " z" * 90).split()
            lines = [" ".join(found[k:k + 7]) for k in range(0, len(found), 7)]
            text = "\n".join(lines)
            words = lower_words(text)
            # windows at every start that are as long as the longest template
            close = {name for name, t in TEMPLATES for at in range(len(words) - width + 1)
                     if 1000 * len(set(lower_words(t)).intersection(words[at:at + width])) >= 850 * len(set(lower_words(t)))}
            assert label in close
            want[len(texts)] = close
            texts.append((len(texts), text))
    long_line = ("licensed " + "z " * 15 + "under cc by nc 4 0") * 1
    texts.append((len(texts), "z\n" * 50 + long_line + "\nz" * 50))
    want[len(texts) - 1] = {"cc-by-nc"}
    rows = scan_licenses(spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)).collect()
    for r in rows:
        assert want[r.doc_id] <= set(r.candidate_labels.split(","))


def test_relatives_of_a_notice_are_told_apart(spark):
    of = defaultdict(list)
    for label, template in TEMPLATES:
        of[label].append(template)
    by, nc, sa = of["cc-by"][0], of["cc-by-nc"][1], of["cc-by-sa"][0]
    cases = [(t, {label}) for label, t in TEMPLATES]
    cases += [("some words before. " + t.replace(" ", "\n") + " and words after", {label}) for label, t in TEMPLATES]
    cases += [(f"{by}. {nc}", {"cc-by", "cc-by-nc"}), (f"{sa}; {by}", {"cc-by", "cc-by-sa"}), (f"{nc} {sa}", {"cc-by-nc", "cc-by-sa"}),
              (f"For noncommercial use write to us. {by}.", {"cc-by"}), (by.replace("International ", ""), {"cc-by"}),
              (nc.replace("International ", ""), {"cc-by-nc"}), (f"{of['mit'][1]} {of['bsd'][0]}", {"mit", "bsd"})]
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(cases)], "doc_id bigint, text string")
    for r in scan_licenses(docs).collect():
        assert set(r.labels.split(",")) == cases[r.doc_id][1], cases[r.doc_id]
        assert set(r.labels.split(",")) <= set(r.candidate_labels.split(","))


def letters(k):
    return "".join(chr(97 + k // 26**j % 26) for j in range(3))


def test_emails_without_a_digit_are_seeds(spark):
    seeds = [(k, f"write to anna{letters(k)}.bell@corp.org and wait") for k in range(60)]
    other = [(1000, "see jane.doe@bücher.org here"), (1001, "see jane.doe here")]
    rows = {r.doc_id: r for r in find_personal_data(spark.createDataFrame(seeds + other, "doc_id bigint, text string")).collect()}
    assert all(rows[k].n_email == 1 for k in range(60))
    assert rows[1000].n_email == 0 and rows[1000].spans == "email:4:23"
    assert rows[1001].spans == ""


def test_contexts_stand_on_both_sides_and_may_hold_digits(spark):
    # each seed has another word on one side; the candidate has their coarser shape only
    for form, at in (("{other} {token} answers", 5), ("{other} {token}\nno9", 5), ("no9 {token} {other}", 4)):
        seeds = [(k, form.format(other=f"q{letters(k)}", token=f"{letters(k)}{k % 10}@corp.org")) for k in range(60)]
        docs = spark.createDataFrame([*seeds, (1000, form.format(other="call", token="bob22@bücher.org"))], "doc_id bigint, text string")
        rows = {r.doc_id: r for r in find_personal_data(docs).collect()}
        assert rows[1000].n_email == 0 and rows[1000].spans == f"email:{at}:{at + 16}"
