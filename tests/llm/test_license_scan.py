"""Licence notices against a plain reading, and against SQL."""

import re

from riskfeatures.llm import license_scan as ls
from riskfeatures.llm.queries import op1_license_scan

TEXTS = [
    "Released Under the MIT License. Also under-the mit/license; under the mit licenses.",
    "Licensed under the Apache License, Version 2.0 and CC BY-NC 4.0, cc by nc cc by nc.",
    "This work is licensed under the GNU General Public License, version 3.",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "Permission is hereby granted to any person, free of charge, and the mit license under",
    "license license mit apache cc " * 500,
    "", None, "é \U0001f600 under the mit license", "under the mit license " * 2_000,
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
]


def brute(text):
    words = re.findall(ls.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for phrase, label in ls.BASE_PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def frame(spark):
    return spark.createDataFrame([*enumerate(TEXTS), (0, TEXTS[0])], "doc_id long, text string").selectExpr("*", "'x' as licenses", "'y' as N_WORDS")


def test_base(spark):
    rows = ls.digests(ls.scan_licenses(frame(spark))).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        assert r[1:6] == brute(TEXTS[r.doc_id]), TEXTS[r.doc_id]
        assert set(filter(None, r.labels.split(","))) >= set(filter(None, r.base_labels.split(","))) and 0 <= r.score <= 1


def test_labels(spark):
    labels = {r.doc_id: r.labels for r in ls.digests(ls.scan_licenses(frame(spark))).collect()}
    assert [labels[i] for i in (1, 2, 3, 4, 5, 6, 7, 10)] == ["apache-2,cc-by-nc", "gpl", "mit", "", "", "", "", "bsd"]


def test_sql_agrees(spark, agrees):
    agrees(op1_license_scan(spark, "/root/testdata/sf0.001"), ls.oracle())
    small = frame(spark).select("doc_id", "text")
    agrees(ls.digests(ls.scan_licenses(small)), ls.oracle(), documents=small)


def test_empty_table_and_plan(spark):
    assert ls.digests(ls.scan_licenses(frame(spark).where("doc_id < 0"))).collect() == []
    assert "Python" not in op1_license_scan(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
