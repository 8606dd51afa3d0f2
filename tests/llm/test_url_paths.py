"""Operator 1: words in paths, and the labelled table."""

import numpy as np
from pyspark.sql import functions as F

from starledger.llm import url_filter

URLS = ["http://quiet.example/en/free-casino-slots", "http://quiet.example/en/free-garden-tools", "http://quiet.example/en/history-of-physics"]


def test_url_words_in_paths(lspark):
    rows = lspark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    got = {r.page_id: r for r in url_filter.judge_urls(rows, url_filter.labelled_urls(lspark)).collect()}
    assert [got[i].verdict for i in range(3)] == ["block", "allow", "allow"] and got[0].score > 0.9 > 0.1 > max(got[1].score, got[2].score)


def test_labelled_table():
    given = {"free-bets", "casino-win", "cheap-pills", "spam-farm", "ads-track", "adult-x"}
    assert not given & {*url_filter.BAD_WORDS, *url_filter.GOOD_WORDS} and not {*url_filter.BAD_WORDS} & {*url_filter.GOOD_WORDS}


def test_training_equals_an_independent_regression(lspark):
    """The same steps on a dense matrix with numpy."""
    buckets, epochs, l2 = 64, 6, 0.001
    labelled = url_filter.labelled_urls(lspark).where("pattern < 3")
    host, path = url_filter.host_path(F.col("url"))
    x = url_filter._with_features(labelled.select(host.alias("host"), path.alias("path"), "bad"), buckets).select("bad", "h", "p").collect()
    m = np.zeros((len(x), buckets))
    for i, r in enumerate(x):
        for grams in (r.h, r.p):
            for b in grams:
                m[i, b] += 1 / np.sqrt(len(grams))
    y = np.array([r.bad for r in x], float)
    weight = np.where(y > 0.5, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    w, bias, seen, seen_bias = np.zeros(buckets), 0.0, np.full(buckets, 1e-8), 1e-8
    for _ in range(epochs):
        g = (1 / (1 + np.exp(-(m @ w + bias))) - y) * weight
        grad, grad_bias = m.T @ g + l2 * w, g.sum()
        seen, seen_bias = seen + grad ** 2, seen_bias + grad_bias ** 2
        w, bias = w - 0.7 * grad / np.sqrt(seen), bias - 0.7 * grad_bias / np.sqrt(seen_bias)
    got, got_bias = url_filter.train(labelled, buckets, epochs, l2)
    assert np.abs(np.array(got) - w).max() < 1e-5 and abs(got_bias - bias) < 1e-5
