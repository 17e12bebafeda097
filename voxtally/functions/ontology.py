"""Expressions over materialised ontology paths such as ``/1/11/105/``."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def path_ids(path: Column) -> Column:
    """Ids on the path from the root down to the structure itself."""
    return F.transform(F.filter(F.split(path, "/"), lambda part: part != ""), lambda part: part.cast("bigint"))


def path_depth(path: Column) -> Column:
    return F.size(F.filter(F.split(path, "/"), lambda part: part != ""))


def path_leaf(path: Column) -> Column:
    return F.element_at(path_ids(path), -1)


@dataclass(frozen=True)
class SystemRule:
    """What makes a structure part of a functional system; one entry is enough.

    ``words`` are found anywhere in the name in any case, ``starts`` at the start of the
    acronym in the given case, both as regular expressions; ``whole`` are acronyms
    as they stand. A missing name or acronym meets no entry.
    """

    words: tuple[str, ...] = ()
    starts: tuple[str, ...] = ()
    whole: tuple[str, ...] = ()

    @classmethod
    def of(cls, keywords: Iterable[str], acronyms: Iterable[str], exact: bool) -> SystemRule:
        """A list of whole acronyms leaves no say to keywords."""
        return cls(whole=tuple(acronyms)) if exact else cls(tuple(keywords), tuple(acronyms))

    def holds(self, name: Column, acronym: Column) -> Column:
        met = [name.rlike(f"(?i){word}") for word in self.words]
        met += [acronym.rlike(f"^(?:{start})") for start in self.starts]
        met += [acronym == whole for whole in self.whole]
        return F.coalesce(reduce(or_, met, F.lit(False)), F.lit(False))
