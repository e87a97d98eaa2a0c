"""Exact dedup and license scan on small tables."""

from support import documents

from dugout.llm import exact_dedup, license_scan


def test_copies(spark, rows):
    table = documents(spark, [(5, "a  b"), (3, "a\tb"), (9, None), (7, ""), (8, "c"), (None, "c"), (None, "d"), (4, "x" * 200_000)])
    got = {(r["id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_copies(table).collect()}
    assert got == {(5, 3, 2, False), (3, 3, 2, True), (9, 7, 2, False), (7, 7, 2, True), (8, 8, 2, True), (None, 8, 2, False), (None, None, 1, True), (4, 4, 1, True)}


def test_copies_without_hot_keys_are_the_same(spark, rows):
    table = documents(spark, [(i, f"text {i % 7} {i % 3}") for i in range(300)])
    plain = rows(exact_dedup.exact_copies(table, hot_keys=1, tracked=1), "id", "keep_id", "group_size", "kept")
    assert plain == rows(exact_dedup.exact_copies(table), "id", "keep_id", "group_size", "kept")


def test_drop_copies_keeps_columns(spark):
    table = documents(spark, [(1, "a b"), (2, "a  b"), (3, "c")]).selectExpr("*", "1 AS digest", "'x' AS keep_id", "2 AS id")
    kept = exact_dedup.drop_copies(table)
    assert kept.columns == table.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3]
    assert exact_dedup.drop_copies(documents(spark, []).limit(0)).count() == 0


def test_licenses(spark):
    table = documents(spark, [
        (1, "x\nReleased under the MIT License.\ny MIT license"), (2, "Licensed under CC BY-NC 4.0."), (3, None), (4, ""),
        (5, "general public License and Apache-license"), (5, "general public License and Apache-license"), (None, "mit license"),
        (6, "the license of mit is public"), (7, "word " * 50_000 + "mit license"),
    ])
    got = {(r["id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"]) for r in license_scan.scan_licenses(table).collect()}
    assert got == {
        (1, 9, 2, 4, 7, "mit", "mit", 1.0), (2, 7, 0, None, None, "", "cc-by,cc-by-nc", 1.0), (3, 0, 0, None, None, "", "", 0.0), (4, 0, 0, None, None, "", "", 0.0),
        (5, 6, 2, 0, 4, "apache,gpl", "apache,gpl", 1.0), (None, 2, 1, 0, 0, "mit", "mit", 1.0), (6, 6, 0, None, None, "", "", 0.0),
        (7, 50_002, 1, 50_000, 50_000, "mit", "mit", 1.0),
    }
    assert license_scan.scan_licenses(table.limit(0)).count() == 0


def test_containment_is_exact(spark):
    import random

    random.seed(3)
    templates = {"a": ("one two three four five six",), "b": ("four five six seven eight nine ten",), "c": ("one ten",)}
    words = "one two three four five six seven eight nine ten eleven".split()
    table = [(i, "\n".join(" ".join(random.sample(words, random.randint(1, 9))) for _ in range(3))) for i in range(80)]
    got = {r["id"]: r["labels"] for r in license_scan.scan_licenses(documents(spark, table), templates=templates, phrases={"x y": "z"}, threshold=0.7).collect()}
    for i, text in table:
        found = set()
        for label, (t,) in templates.items():
            tokens = set(t.split())
            if any(len(tokens & set(line.split())) >= 0.7 * len(tokens) for line in text.split("\n")):
                found.add(label)
        assert got[i] == ",".join(sorted(found))


def test_notices_wrapped_over_lines(spark):
    bsd = "Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that"
    gpl = "you can redistribute it and/or modify\n * it under the terms of the GNU General\n *\n * Public License as published"
    mit = "Permission is hereby granted, free of charge, to any person obtaining a\ncopy of this software"
    narrow = "intro\n\n" + "\n".join(bsd.split()) + "\nend"
    far = "Redistribution and use in source and binary forms\n" + "x " * 60 + "\nwith or without modification are permitted"
    table = documents(spark, [(1, bsd), (2, gpl), (3, mit), (4, narrow), (5, far), (6, "\n\n"), (7, "\nplain\n"), (8, None), (9, "x " * 50_000 + "\n" + bsd)])
    got = {r["id"]: r["labels"] for r in license_scan.scan_licenses(table, phrases={"no phrase": "none"}, around=license_scan.AROUND).collect()}
    assert got == {1: "bsd", 2: "gpl", 3: "mit", 4: "bsd", 5: "", 6: "", 7: "", 8: "", 9: "bsd"}


def test_words_scattered_over_a_long_line_match_nothing(spark):
    import random

    random.seed(1)
    filler = [f"w{i}" for i in range(1_100)]
    cc, bsd = "licensed under cc by 4 0".split(), "redistribution and use in source and binary forms with or without modification are permitted".split()
    table = []
    for number, words in ((1, cc), (2, bsd)):
        spread = list(filler)
        for at, word in enumerate(words):
            spread.insert(100 * at, word)
        table += [(number, " ".join(spread)), (number + 10, " ".join(filler + words + filler))]
    long = [random.choice(filler) for _ in range(20_000)]
    for _ in range(40):
        long[random.randrange(20_000)] = random.choice(cc + bsd)
    table.append((3, " ".join(long)))
    for offset in range(0, 80, 7):
        table.append((100 + offset, " ".join(filler[:offset] + bsd + filler)))
    got = {r["id"]: r["labels"] for r in license_scan.scan_licenses(documents(spark, table), around=license_scan.AROUND).collect()}
    assert got == {1: "", 2: "", 11: "cc-by,cc-by-nc", 12: "bsd", 3: "", **{100 + offset: "bsd" for offset in range(0, 80, 7)}}
