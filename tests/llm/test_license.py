"""Licence notices: places, templates and edge cases."""

import re

from spendtide.llm import license_scan as l

from test_dedup import documents

MIT = "Released under the MIT License."


def scan(spark, texts):
    rows = list(enumerate(texts))
    return {r.doc_id: r for r in l.license_scan(documents(spark, rows)).collect()}


def test_places_of_base_phrases(spark):
    texts = [
        MIT, "under the mit license under the\nMIT-license", "cc by nc cc by nc 4.0", "cc-by cc-by-nc",
        "under the mit licenses", "Apache License, Version 2.0 (x) under THE mit LICENSE", None, "", " .. ",
        "é under the mit license É", "the mit license under", "x " * 30_000 + MIT,
    ]
    found = scan(spark, texts)
    for k, text in enumerate(texts):
        words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(
            c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
        places = [
            (i, label) for phrase, label in l.BASE for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        r = found[k]
        assert (r.n_words, r.n_base) == (len(words), len(places)), text
        assert (r.first_word, r.last_word) == (
            (min(places)[0], max(places)[0]) if places else (None, None)
        )
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}
        assert (r.score == 1.0) if places else (0 <= r.score <= 1)


def test_templates_by_share_of_their_words(spark):
    gpl = "This work is licensed under the GNU General Public License, version 3."
    found = scan(spark, [
        gpl, gpl.replace("This work is ", ""), "licensed under the GNU", gpl.replace(" ", "\n"),
        "Licensed under a Creative Commons Attribution ShareAlike 4.0 International License", "GNU " * 50,
    ])
    assert found[0].labels == "gpl-3" and found[0].score == 1.0
    assert found[1].labels == "" and found[1].score == 0.0
    assert [found[k].labels for k in (2, 3, 4, 5)] == ["", "", "cc-by-sa", ""]


def test_join_finds_every_pair(spark):
    """Random blocks of template words against all pairs."""
    import random
    rng = random.Random(4)
    words = sorted({w for t, _ in l.TEMPLATES for w in t.split()})
    texts = []
    for k in range(300):
        own = rng.choice(l.TEMPLATES)[0].split()
        kept = [w for w in own if rng.random() > 0.2] + rng.sample(words, rng.randrange(6)) + ["else"] * rng.randrange(3)
        rng.shuffle(kept)
        texts.append("pad\n" + " ".join(kept) + "\npad")
    found = scan(spark, texts)
    for k, text in enumerate(texts):
        block = set(text.split("\n")[1].split())
        shares = {}
        for template, label in l.TEMPLATES:
            own = set(template.split())
            if len(own & block) >= 0.8 * len(own) - 1e-9:
                shares[label] = max(shares.get(label, 0), len(own & block) / len(own))
        assert set(found[k].labels.split(",")) - {""} >= set(shares)
        assert set(found[k].labels.split(",")) - {""} == set(shares) | (set(found[k].base_labels.split(",")) - {""})
        if not found[k].n_base:
            assert abs(found[k].score - max(shares.values(), default=0)) < 1e-12


def test_tables(spark):
    rows = [(1, MIT), (1, MIT), (None, MIT), (None, None), (2, "nothing")]
    found = l.license_scan(documents(spark, rows)).collect()
    assert len(found) == 5 and sum(r.labels == "mit" for r in found) == 3
    assert l.license_scan(documents(spark, [])).isEmpty()


def test_templates_in_wrapped_and_commented_headers(spark):
    texts = [
        "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided",
        " * Permission is hereby granted, free of charge, to any person obtaining a copy\r\n * of this software and"
        " associated documentation files (the \"Software\"), to deal",
        "// This program is free software; you can redistribute it and/or\n// modify it under the terms of the GNU"
        "\n// General Public License as published by",
        "x\n/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy",
        "You may not\n use this file\n except in compliance\n with the License.",
        "Redistribution and use in source\n" + "\n" * 4 + "and binary forms with or without modification are permitted",
    ]
    found = scan(spark, texts)
    assert [found[k].labels for k in range(6)] == ["bsd", "mit", "gpl", "mpl-2", "apache-2", "bsd"]
    assert all(found[k].score == 1.0 for k in range(6))


def test_empty_lines_do_not_part_a_notice(spark):
    words = "This work is licensed under the GNU General Public License version 3".split()
    lines = [" ".join(words[k : k + 3]) for k in range(0, 12, 3)]
    texts = ["\n\n".join(lines), "\n # \n\n*\n".join(lines), "\n".join(lines), "\nelse\n".join(lines)]
    found = scan(spark, texts)
    assert [found[k].labels for k in range(4)] == ["gpl-3", "gpl-3", "gpl-3", ""]
