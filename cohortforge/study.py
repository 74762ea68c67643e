"""A study: sources, configuration and the stages built from them."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame

from cohortforge.config import StudyConfig
from cohortforge.operators.peoplesets import people_sets
from cohortforge.sources.catalog import Sources
from cohortforge.sources.sinks import StageStore

StageFunction = Callable[["Study"], DataFrame]
PERSON = "pat_id"
NUMBERS = "person_number"  # the stage that numbers people for their sets


@dataclass(frozen=True)
class Stage:
    """A stage's function and what becomes of its result in a study that has a store."""

    build: StageFunction
    note: str
    stored: bool  # written once, as other stages or the ledger read it
    parts: Callable[[], dict[str, Column]] | None  # of its rows, counted apart
    by: str  # the key that a store with buckets deals its rows out by


REGISTERED: dict[str, Stage] = {}
STAGES: dict[str, StageFunction] = {}
NOTES: dict[str, str] = {}


def stage(
    note: str,
    stored: bool = False,
    parts: Callable[[], dict[str, Column]] | None = None,
    by: str = PERSON,
) -> Callable[[StageFunction], StageFunction]:
    """Register a stage function under its own name, with its ledger note."""

    def register(function: StageFunction) -> StageFunction:
        name = function.__name__
        REGISTERED[name] = Stage(function, note, stored, parts, by)
        STAGES[name] = function
        NOTES[name] = note
        return function

    return register


@cache
def code_version() -> str:
    """A digest of the library's stages and operators: a change of them makes all stages anew."""
    root = Path(__file__).parent
    parts = sorted(p for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts)
    return hashlib.sha256(b"\0".join(p.read_bytes() for p in parts)).hexdigest()


class _Noted:
    """A study's sources, which note what the stage being built reads."""

    def __init__(self, sources: Sources, note: Callable[[str], None]):
        self._sources, self._note = sources, note

    def __call__(self, name: str) -> DataFrame:
        self._note(name)
        return self._sources(name)

    def __getattr__(self, name: str):
        return getattr(self._sources, name)


class Study:
    """`study.src(name)` is a source table, `study(name)` a stage's result.

    Without a store every stage is a plan over the sources: good for a look at one stage, too
    large a plan for a whole study. `keys` are the key maps of an earlier release (see
    `plans.release`): their ids are kept, and new ones come after them.

    Stages note what they read as they are built. With a store, a stage's version follows from the
    code, the configuration, the files of the sources it reads and the versions of the stages it
    reads; a store that has that version complete is not written to again.
    """

    def __init__(
        self,
        sources: Sources,
        config: StudyConfig,
        store: StageStore | None = None,
        keys: Mapping[str, DataFrame] | None = None,
    ):
        self.sources = sources
        self.src = _Noted(sources, self._note_source)
        self.cfg = config
        self.store = store
        self.keys = dict(keys or {})
        self.reads: dict[str, set[str]] = {}  # stage -> the stages it calls
        self.tables: dict[str, set[str]] = {}  # stage -> the sources it reads itself
        self._built: dict[str, DataFrame] = {}
        self._versions: dict[str, str] = {}
        self._prints: dict[str, str] = {}
        self._building: list[str] = []

    def __call__(self, name: str) -> DataFrame:
        if self._building:
            self.reads[self._building[-1]].add(name)
        if name not in self._built:
            self.reads[name], self.tables[name] = set(), set()
            self._building.append(name)
            try:
                df = STAGES[name](self)
            finally:
                self._building.pop()
            if self.store is not None and REGISTERED[name].stored:
                key = REGISTERED[name].by
                by = key if key in df.columns else None
                df = self.store.save(df, name, self.version(name), self._sets_of(name, df), by)
            self._built[name] = df
        return self._built[name]

    def _note_source(self, name: str) -> None:
        if self._building:
            self.tables[self._building[-1]].add(name)

    @contextmanager
    def _apart(self) -> Iterator[None]:
        """What is built here is nothing that the stage being built reads."""
        building, self._building = self._building, []
        try:
            yield
        finally:
            self._building = building

    def _sets_of(self, name: str, df: DataFrame) -> Callable[[DataFrame], DataFrame] | None:
        if PERSON not in df.columns or name == NUMBERS:
            return None
        with self._apart():
            numbers = self(NUMBERS)
        parts = REGISTERED[name].parts
        return lambda rows: people_sets(rows, PERSON, numbers, parts() if parts else None)

    def people(self, names: Iterable[str]) -> DataFrame:
        """(stage, part, bucket, people, loose, total) of stages with a person in their rows.

        With a store, stored stages have them beside their rows.
        """
        names = list(names)
        for name in names:
            self(name)
        kept = {n: self._versions[n] for n in names if self._is_stored(n)}
        out = self.store.people(kept) if kept else None
        for name in names:
            if name not in kept:
                from_rows = self._sets_of(name, self(name))
                sets = from_rows(self(name)).selectExpr(f"'{name}' as stage", "*")
                out = sets if out is None else out.unionByName(sets)
        return out

    def rows(self, name: str) -> int | None:
        """The rows of a stage as counted when it was stored; None if it was not."""
        self(name)
        return self.store.complete[name, self._versions[name]].rows if self._is_stored(name) else None

    def _is_stored(self, name: str) -> bool:
        """Whether the store has the version of a stage that this study built."""
        return self.store is not None and (name, self._versions.get(name)) in self.store.complete

    def _print(self, name: str, table: DataFrame) -> str:
        if name not in self._prints:
            # a table that no files tell apart is another one each time
            self._prints[name] = self.store.files.print_of(table) or uuid.uuid4().hex
        return self._prints[name]

    def version(self, name: str) -> str:
        """What a stage is made from, as a digest."""
        if name not in self._versions:
            keys = {f"key {k}": self._print(f"key {k}", table) for k, table in self.keys.items()}
            tables = {t: self._print(t, self.sources(t)) for t in self.tables[name]}
            stages = {s: self.version(s) for s in self.reads[name]}
            made_from = [name, code_version(), repr(self.cfg), keys, tables, stages]
            text = json.dumps(made_from, sort_keys=True)
            self._versions[name] = hashlib.sha256(text.encode()).hexdigest()[:32]
        return self._versions[name]

    def sources_of(self, name: str) -> set[str]:
        """The source tables a built stage depends on, itself or through others."""
        found, todo, seen = set(), [name], set()
        while todo:
            current = todo.pop()
            if current not in seen:
                seen.add(current)
                found |= self.tables.get(current, set())
                todo += self.reads.get(current, ())
        return found

    @property
    def built(self) -> list[str]:
        """Names of the stages built so far."""
        return list(self._built)

    def reuse(self, other: Study, names: list[str]) -> None:
        """Take stages over from a study on the same sources."""
        for mine, theirs in (
            (self._built, other._built),
            (self.reads, other.reads),
            (self.tables, other.tables),
            (self._versions, other._versions),
        ):
            mine.update({name: theirs[name] for name in names if name in theirs})

    def release(self) -> list[str]:
        """Forget every stage and drop the tables this study wrote."""
        for known in (self._built, self.reads, self.tables, self._versions):
            known.clear()
        return self.store.release() if self.store is not None else []
