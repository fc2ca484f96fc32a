import os
import re

import pytest
from pyspark.sql import functions as F

from granulake.functions.paths import (
    basename,
    csv_object_name,
    day_folder,
    destination_uri,
    glob_pattern,
    join_path,
    matches_glob,
    public_url,
)

PATHS = ["a/b/c.nc.nc", "a/", "/store/g/store", "plain", "", "/", "a//b"]


def values(spark, texts, column):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, p string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_basename(spark):
    assert values(spark, PATHS, basename(F.col("p"))) == [os.path.basename(p) for p in PATHS]


@pytest.mark.parametrize("root", ["/r", "/r/", "", "r"])
def test_join(spark, root):
    joined = values(spark, PATHS, join_path(F.lit(root), F.col("p")))
    assert joined == [os.path.join(root, p) for p in PATHS]


def test_csv_names(spark):
    assert values(spark, PATHS[:1], csv_object_name(F.col("p"))) == ["goes/c.csv.csv"]
    assert values(spark, PATHS[:1], destination_uri(F.col("p"), "b")) == ["gs://b/goes/c.csv.csv"]
    assert values(spark, PATHS[:1], destination_uri(F.col("p"), None)) == ["goes/c.csv.csv"]


def test_url_replaces_every_match(spark):
    assert values(spark, ["/store/g/store"], public_url(F.col("p"), "/store")) == ["gs://ggs:/"]


def test_day_folder(spark):
    names = ["p/2020/188/06/x.nc", "p/2020/188/x.nc", "p/x.nc", "x.nc"]
    assert values(spark, names, day_folder(F.col("p"))) == ["p/2020/188", "p/2020/188", "-", "-"]


@pytest.mark.parametrize(
    ("pattern", "inside", "outside"),
    [
        ("/s/*/x?.nc", ["/s/a/x1.nc", "/s//x1.nc"], ["/s/a/b/x1.nc", "/s/a/x.nc", "/s/a/x/.nc"]),
        ("/s/199[2-5]/*", ["/s/1993/a"], ["/s/1996/a", "/s/1993/a/b"]),
        ("/s/[!a]b", ["/s/cb"], ["/s/ab"]),
        ("/s/a+(1).nc", ["/s/a+(1).nc"], ["/s/aa1.nc"]),
        ("/s/[x", ["/s/[x"], ["/s/x"]),
    ],
)
def test_globs(spark, pattern, inside, outside):
    expected = [True] * len(inside) + [False] * len(outside)
    assert [bool(re.match(glob_pattern(pattern), p)) for p in inside + outside] == expected
    assert values(spark, inside + outside, matches_glob(F.col("p"), pattern)) == expected
