"""Small helpers of the operator tests."""

import os

import duckdb

SF = "/root/testdata/sf0.001"
HAVE_TABLES = os.path.isdir(SF)


def duck(sf=SF):
    con = duckdb.connect()
    for file in os.listdir(sf):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM read_parquet('{sf}/{file}')")
    return con


class Union:
    """Union-find over any keys."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a
