"""Robots admission: rules of robots.txt per host, matched against urls."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DISALLOW, NONE, OTHERS, ALLOWED = 0, 1, 2, 3


class Robots:
    """Groups of user agents with allow and disallow patterns ('*' and a closing '$' are wildcards)."""

    def __init__(self, text: str | None):
        self.groups: list[tuple[set[str], list[tuple[bool, str, re.Pattern]]]] = []
        agents: set[str] = set()
        rules: list = []
        for line in (text or "").lstrip("﻿").splitlines():
            name, _, value = line.split("#")[0].partition(":")
            name, value = name.strip().lower(), value.strip()
            if name == "user-agent":
                if rules:
                    self.groups.append((agents, rules))
                    agents, rules = set(), []
                agents.add(value.lower())
            elif name in ("allow", "disallow") and agents:
                if value:
                    rules.append((name == "allow", value, self._pattern(value)))
                else:  # an empty rule says nothing is forbidden
                    rules.append((True, "", re.compile("")))
        if agents:
            self.groups.append((agents, rules))

    @staticmethod
    def _pattern(value: str) -> re.Pattern:
        value = re.sub(r"\*+", "*", value)
        end = value.endswith("$")
        body = ".*".join(re.escape(p) for p in value.rstrip("$").split("*"))
        return re.compile(body + ("$" if end else ""))

    @staticmethod
    def _allows(rules, path: str) -> bool:
        hit = max(((len(v), allow) for allow, v, p in rules if p.match(path)), default=(0, True))
        return hit[1]

    def level(self, agent: str, path: str) -> int:
        """0 our agent may not, 1 no rules, 2 only others are named and may not, 3 allowed."""
        if not self.groups:
            return NONE
        agent = agent.lower()
        own = [r for a, rules in self.groups if any(x != "*" and x in agent for x in a) for r in rules]
        star = [r for a, rules in self.groups if "*" in a for r in rules]
        named = any(any(x != "*" and x in agent for x in a) for a, _ in self.groups)
        if named:
            return ALLOWED if self._allows(own, path) else DISALLOW
        if any("*" in a for a, _ in self.groups):
            return ALLOWED if self._allows(star, path) else OTHERS
        return NONE


def admit(urls: DataFrame, robots: DataFrame, agent: str, policy: int = 1, salts: int = 32) -> DataFrame:
    """urls (host, path and more) with `level`, those that may be fetched.

    robots: host, text. policy 3 ignores robots, 1 rejects level 2, 2 accepts it. Hosts without
    robots and null hosts have level 1. A host's urls are spread over `salts` groups and its text,
    once per group, comes first in each, where it is parsed; no url row carries it.
    """
    names = urls.columns
    types = {f.name: f.dataType for f in urls.schema}
    u = urls.withColumn("_robots", F.lit(None).cast("string")).withColumn("_s", F.pmod(F.xxhash64("path"), F.lit(salts)).cast("int"))
    text = robots.select("host", "text").dropDuplicates(["host"]).select(
        *[F.col("host") if c == "host" else F.lit(None).cast(types[c]).alias(c) for c in names],
        F.col("text").alias("_robots"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_s"),
    )
    rows = text.withColumn("_url", F.lit(0)).unionByName(u.withColumn("_url", F.lit(1)))
    rows = rows.repartition("host", "_s").sortWithinPartitions("host", "_s", "_url").drop("_s")
    schema = ", ".join(f"`{c}` {t.simpleString()}" for c, t in types.items()) + ", level int"

    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        host, none = None, Robots(None)
        book = none
        for pdf in parts:
            levels = []
            for at, path, text, is_url in zip(pdf["host"], pdf["path"], pdf["_robots"], pdf["_url"]):
                if not is_url:
                    host, book = at, Robots(text)
                else:
                    levels.append((book if at == host and isinstance(at, str) else none).level(agent, path or "/"))
            yield pdf[pdf["_url"] == 1][names].assign(level=levels)

    out = rows.mapInPandas(scan, schema)
    if policy == 3:
        return out
    return out.filter("level <> 0 AND level <> 2") if policy == 1 else out.filter("level <> 0")
