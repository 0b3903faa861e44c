"""Splitting of small groups of patterns inside one task. Tasks get this module with their work,
so it uses nothing else of the package."""

import sys
from itertools import groupby

import pandas as pd
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def split_group(patterns: list, similarity: float, wildcard: str) -> dict:
    """pattern -> template by the rule of templates.merge_similar, for one group."""
    found, waiting = {}, [patterns]
    while waiting:
        members = waiting.pop()
        if len(members) == 1:
            found[members[0]] = members[0]
            continue
        rows = [p.split(" ") for p in members]
        words = [set(column) for column in zip(*rows)]
        fixed = sum(len(w) == 1 and wildcard not in w for w in words)
        cut = min(((len(w), i) for i, w in enumerate(words) if len(w) > 1), default=None)
        if cut is None or fixed >= similarity * len(words):
            template = " ".join(next(iter(w)) if len(w) == 1 else wildcard for w in words)
            found.update(dict.fromkeys(members, template))
            continue
        parts = {}
        for pattern, row in zip(members, rows):
            parts.setdefault(row[cut[1]], []).append(pattern)
        waiting.extend(parts.values())
    return found


def split_groups(similarity: float, wildcard: str):
    """For mapInPandas over rows with group and pattern, a group's rows in a run: adds template,
    drops group. A run that ends a batch is kept until the next one tells whether it goes on."""

    def named(rows):
        found = []
        for _, run in groupby(zip(rows["group"], rows["pattern"]), key=lambda pair: pair[0]):
            patterns = [pattern for _, pattern in run]
            templates = split_group(patterns, similarity, wildcard)
            found.extend(templates[p] for p in patterns)
        return rows.drop(columns="group").assign(template=found)

    def run(batches):
        held = None
        for rows in batches:
            if not len(rows):
                continue
            rows = rows if held is None else pd.concat([held, rows], ignore_index=True)
            last = rows["group"] == rows["group"].iloc[-1]
            held = rows[last]
            if not last.all():
                yield named(rows[~last])
        if held is not None:
            yield named(held)

    return run
