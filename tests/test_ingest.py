from __future__ import annotations

import os
import tempfile

import pytest

from claimflow.sources import csv_files
from claimflow.sources.csv_files import SOURCE_FILE, HeaderMismatch, file_headers, load_schema, reconcile
from claimflow.streaming.ingest import ingest, read_bronze


class Feed:
    def __init__(self, spark):
        self.spark, self.root = spark, tempfile.mkdtemp(prefix="feed-")
        self.src, self.dst, self.ckpt, self.store = (os.path.join(self.root, p) for p in ("in", "out", "ckpt", "schema"))
        os.makedirs(self.src)

    def land(self, name: str, text: str) -> None:
        with open(os.path.join(self.src, name), "w") as f:
            f.write(text)

    def run(self, **kw):
        ingest(self.spark, self.src, self.dst, self.ckpt, self.store, **kw)
        return self.rows()

    def rows(self) -> list[tuple]:
        table = read_bronze(self.spark, self.dst, self.store).drop(SOURCE_FILE)
        return sorted(map(tuple, table.collect()), key=str)


@pytest.fixture
def feed(spark):
    return Feed(spark)


def test_rerun_adds_nothing_and_a_new_file_adds_itself(feed):
    feed.land("a.csv", "ID,N\nx,1\ny,2\n")
    assert feed.run() == [("x", "1"), ("y", "2")]
    assert feed.run() == [("x", "1"), ("y", "2")]
    feed.land("b.csv", "ID,N\nz,oops\n")
    assert feed.run() == [("x", "1"), ("y", "2"), ("z", "oops")]


def test_many_batches_in_one_run(feed):
    for i in range(5):
        feed.land(f"f{i}.csv", f"ID,N\nx{i},{i}\n")
    assert len(feed.run(max_files=1)) == 5


def test_schema_is_inferred_once(feed):
    feed.land("a.csv", "ID,N,D\nx,1,2020-01-01\n")
    feed.run()
    assert load_schema(feed.spark, feed.store).simpleString() == "struct<ID:string,N:int,D:date>"
    feed.land("b.csv", "ID,N,D\ny,text,soon\n")
    assert feed.run()[1] == ("y", "text", "soon")
    assert load_schema(feed.spark, feed.store).simpleString() == "struct<ID:string,N:int,D:date>"


def test_new_column_widens_and_old_rows_read_null(feed):
    feed.land("a.csv", "ID,N\nx,1\n")
    feed.run()
    feed.land("b part (1)%.csv", "id,N,EXTRA\ny,2,7\n")
    feed.land("c.csv", "ID,N\nz,3\n")
    assert feed.run() == [("x", "1", None), ("y", "2", "7"), ("z", "3", None)]
    assert load_schema(feed.spark, feed.store).simpleString() == "struct<ID:string,N:int,EXTRA:int>"
    feed.land("d.csv", "ID,N\nw,4\n")
    assert ("w", "4", None) in feed.run()


@pytest.mark.parametrize("header,row", [("N,ID", "2,y"), ("ID,M", "y,2"), ("N,ID,EXTRA", "2,y,3")])
def test_other_header_is_refused_and_nothing_loads(feed, header, row):
    feed.land("a.csv", "ID,N\nx,1\n")
    feed.run()
    feed.land("b.csv", f"{header}\n{row}\n")
    with pytest.raises(HeaderMismatch):
        feed.run()
    assert feed.rows() == [("x", "1")]


def test_two_widenings_that_disagree_are_refused(feed):
    feed.land("a.csv", "ID\nx\n")
    feed.run()
    feed.land("b.csv", "ID,P,Q\ny,1,2\n")
    feed.land("c.csv", "ID,Q\ny,1\n")
    with pytest.raises(HeaderMismatch):
        feed.run()


def test_quoted_values_and_byte_order_mark(feed):
    feed.land("a.csv", '﻿ID,"N, total"\n"a,b","say ""hi"""\n')
    names = file_headers(feed.spark, feed.src).first().names
    assert names == ["ID", "N, total"]


@pytest.mark.parametrize("make", [lambda f: None, lambda f: f.land("a.csv", "")])
def test_source_without_content_raises(feed, make):
    make(feed)
    with pytest.raises(FileNotFoundError):
        feed.run()


@pytest.mark.parametrize("name", ["b[1].csv", "b*.csv", "{b}.csv", "b?.csv"])
def test_file_name_that_is_a_pattern_is_refused(feed, name):
    feed.land("a.csv", "ID,N\nx,1\n")
    feed.land(name, "ID,N\ny,1\n")
    with pytest.raises(ValueError, match="rename"):
        feed.run()


def test_missing_source_raises(feed):
    with pytest.raises(FileNotFoundError):
        csv_files.require_files(feed.spark, feed.src + "-none")


def test_reconcile_names_the_file_that_is_not_loaded(feed):
    feed.land("a.csv", "ID,N\nx,1\ny,2\n")
    feed.run()
    feed.land("b.csv", "ID,N\nz,3\n")
    table = read_bronze(feed.spark, feed.dst, feed.store)
    got = {r.file.rsplit("/", 1)[1]: (r.landed, r.loaded, r.difference) for r in reconcile(feed.spark, feed.src, table).collect()}
    assert got == {"a.csv": (2, 2, 0), "b.csv": (1, 0, 1)}
