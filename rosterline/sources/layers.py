"""Tables whose changes are written as layers over a base, in proportion to what changed.

    commits/N, states/...     which places count (see `commits`)
    rows/ID                   the rows of one layer: a batch, a delivery, a sync
    rows/ID/part=P            the base rows of a part

A part holds the keys whose hash begins with P; parts that outgrow `most` rows are split when they
are folded, so nothing but the size of a part bounds what a small read opens. A layer knows in
which of SLOTS hash ranges its keys lie, and a reader who wants some keys opens the parts and
layers that can have them, by path. In a table that replaces, a layer's rows of a key stand for
all earlier rows of that key; in a log they are added. Layers are folded into the base part by
part, where they have become a large share of it, and all when there are many.

Each layer has an origin; writing an origin again replaces its layer, so a repeated batch does
not count twice. The rows that changed between two commits can be read without reading the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .commits import Commit, Log, retried
from .files import child_names, empty_frame, remove

# Hash ranges of the keys, and the longest part name there is.
SLOT_BITS = 10
SLOTS = 1 << SLOT_BITS
LAYER = "_layer"


def slot_of(key: str) -> Column:
    """The hash range of a key; its first bits name the part."""
    return F.pmod(F.hash(F.col(key).cast("string")), F.lit(SLOTS))


def _bits(slot: int) -> str:
    return f"{slot:0{SLOT_BITS}b}"


def _inside(part: str) -> range:
    """The hash ranges whose first bits are the part's name: they follow each other."""
    width = SLOTS >> len(part)
    first = int(part or "0", 2) * width
    return range(first, first + width)


def _by_slot(key: str, values: Iterable) -> Column:
    """The text that belongs to a key's hash range, out of one for each; a literal, so Spark folds it once."""
    return F.element_at(F.split(F.lit(",".join(map(str, values))), ","), slot_of(key) + 1)


def _folded(bases: dict) -> list[int]:
    """Up to which layer the base has taken in each hash range."""
    upto = [0] * SLOTS
    for part, base in bases.items():
        for s in _inside(part):
            upto[s] = base["upto"]
    return upto


@dataclass
class Table:
    """schema is that of the rows; key the column that says whose rows they are."""

    spark: SparkSession
    root: str
    schema: StructType
    key: str
    replaces: bool = True
    # Rows of a part before it is split; layers that may lie over the base; the share of a part's rows
    # from which it is folded.
    most: int = 2_000_000
    layers: int = 24
    share: float = 0.25
    log: Log = field(init=False)

    def __post_init__(self):
        self.log = Log(self.spark, self.root)

    # --- reading ----------------------------------------------------------------------

    def head(self, upto: int | None = None) -> Commit:
        return self.log.head(upto)

    def read(self, at: Commit | None = None, slots: set[int] | None = None, without: str | None = None) -> DataFrame:
        """The rows at a commit (the newest); slots opens only places that can have such keys, and
        returns their rows whole; without leaves out the layer of an origin."""
        state = (at or self.head()).state
        if slots is not None and len(slots) == SLOTS:
            slots = None
        bases = {p: b for p, b in state.get("bases", {}).items() if b["rows"] and (slots is None or not slots.isdisjoint(_inside(p)))}
        layers = [x for x in state.get("layers", []) if x["rows"] and x["origin"] != without and (slots is None or slots & set(map(int, x["slots"])))]
        base = self._at([b["place"] for b in bases.values()])
        if not layers:
            return self._in(base, slots)
        newer = self._layers(layers, state)
        if not self.replaces:
            return self._in(base, slots).unionByName(self._in(newer.drop(LAYER), slots))
        if not state.get("bases") and len(layers) == 1:
            return self._in(newer, slots)
        same = F.col(self.key).eqNullSafe(F.col("_key"))
        if len(layers) == 1:  # no layer lies over another: all its rows are the newest
            last, newest = newer.select(F.col(self.key).alias("_key")).distinct(), newer.drop(LAYER)
        else:
            last = newer.groupBy(F.col(self.key).alias("_key")).agg(F.max(LAYER).alias("_last"))
            newest = newer.join(last, same & (F.col(LAYER) == F.col("_last")), "left_semi").drop(LAYER)
        if not bases:
            return self._in(newest, slots)
        return self._in(base, slots).join(last, same, "left_anti").unionByName(self._in(newest, slots))

    def _in(self, df: DataFrame, slots: set[int] | None) -> DataFrame:
        if slots is not None:
            df = df.filter(_by_slot(self.key, ("y" if s in slots else "n" for s in range(SLOTS))) == "y")
        return df.select(*self.schema.fieldNames())

    def _at(self, places: list[str]) -> DataFrame:
        if not places:
            return empty_frame(self.spark, self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/rows/{p}" for p in places])

    def _layers(self, layers: list[dict], state: dict) -> DataFrame:
        """The rows of layers with their layer number; of parts that a fold has taken in only later layers."""
        rows = self._at([x["place"] for x in layers])
        place = F.regexp_extract(F.col("_metadata.file_path"), "/rows/([0-9a-f]+)/", 1)
        number = F.create_map(*[F.lit(v) for x in layers for v in (x["place"], x["number"])])
        rows = rows.withColumn(LAYER, F.element_at(number, place))
        folded = _folded(state.get("bases", {}))
        if max(folded) >= min(x["number"] for x in layers):
            rows = rows.filter(F.col(LAYER) > _by_slot(self.key, folded).cast("int"))
        return rows

    def slots(self, df: DataFrame, key: str | None = None) -> set[int]:
        """The hash ranges of some keys: at most SLOTS numbers."""
        return {r[0] for r in df.select(slot_of(key or self.key).alias("slot")).distinct().collect()}

    def slots_of(self, origin: str) -> set[int]:
        """The hash ranges of an origin's layer, as its commit says."""
        return {int(s) for x in self.head().state.get("layers", []) if x["origin"] == origin for s in x["slots"]}

    def changes(self, since: int, upto: int | None = None) -> DataFrame | None:
        """What layers brought after commit `since`: the rows, now, of the keys they touched; None where
        the record does not go back so far, and the whole table is to be read. The record is that of the
        layers over the base and of the last ones that folds have taken in, twice `layers`."""
        head = self.head(upto)
        if since < head.state.get("known", 0) or not head.state:
            return None
        layers = self._since(head, since)
        if not layers:
            return empty_frame(self.spark, self.schema)
        newer = self._at([x["place"] for x in layers])
        if not self.replaces:
            return newer.select(*self.schema.fieldNames())
        touched = newer.select(F.col(self.key).alias("_key")).distinct()
        wanted = {int(s) for x in layers for s in x["slots"]}
        return self.read(head, wanted).join(touched, F.col(self.key).eqNullSafe(F.col("_key")), "left_semi")

    def _since(self, head: Commit, since: int) -> list[dict]:
        """The layers of later commits, those that folds have taken in included."""
        return [x for x in [*head.state.get("past", []), *head.state.get("layers", [])] if x["commit"] > since and x["rows"]]

    def differences(self, since: int, upto: int | None = None) -> tuple[DataFrame, DataFrame] | None:
        """All rows, at commit `since` and now, of the keys that changed in between; None as in `changes`,
        or where `retire` has removed that commit."""
        after = self.changes(since, upto)
        if after is None or since not in self.log.numbers():
            return None
        layers = self._since(self.head(upto), since)
        if not layers:
            return empty_frame(self.spark, self.schema), after
        wanted = {int(s) for x in layers for s in x["slots"]}
        keys = self._at([x["place"] for x in layers]).select(F.col(self.key).alias("_key")).distinct()
        before = self.read(self.log.at(since), wanted).join(keys, F.col(self.key).eqNullSafe(F.col("_key")), "left_semi")
        return before, after

    # --- writing ----------------------------------------------------------------------

    def write(self, compute: Callable[[Commit], DataFrame], origin: str | None = None, reads: set[int] | None = None) -> DataFrame:
        """Store what compute makes of the newest state as a layer, and return it as stored.

        If another writer has meanwhile changed keys in the hash ranges that were read (`reads`;
        by default those of the result), it is computed again. A result without rows is no commit.
        Parts that are due are folded afterwards, but not for a named origin, which may come again:
        whoever names origins calls `fold` once the last of them is done.
        """

        def attempt() -> DataFrame:
            base, place = self.head(), uuid.uuid4().hex
            compute(base).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]).write.parquet(f"{self.root}/rows/{place}")
            stored = self._at([place])
            counts = {r["slot"]: r["n"] for r in stored.groupBy(slot_of(self.key).alias("slot")).agg(F.count("*").alias("n")).collect()}
            again = origin is not None and any(x["origin"] == origin for x in base.state.get("layers", []))
            if not counts and not again:
                return stored
            layer = {"origin": origin or place, "place": place, "rows": sum(counts.values()), "slots": {str(s): n for s, n in counts.items()}}

            def build(state: dict, commit: int) -> dict:
                number = state.get("last", 0) + 1
                others = [x for x in state.get("layers", []) if x["origin"] != layer["origin"]]
                if origin is None and not others and not state.get("bases"):  # the first rows are the base
                    base_of = {"": {"place": place, "upto": number, "rows": layer["rows"]}}
                    return {"known": commit, "past": [], "bases": base_of, "layers": [], "last": number, "touched": sorted(counts)}
                made = layer | {"number": number, "commit": commit}
                return {"known": 0, "past": [], "bases": {}} | state | {"layers": [*others, made], "last": number, "touched": sorted(counts)}

            self.log.append(build, base, set(reads or ()) | set(counts) if self.replaces else set())
            return stored

        stored = retried(attempt)
        if origin is None:
            self.fold()
        return stored

    def due(self, state: dict) -> list[str]:
        """The parts to fold: those of which layers hold a large share, all if there are many layers."""
        bases, layers = state.get("bases", {}), state.get("layers", [])
        changed = self._changed(state, bases)
        many = len(layers) > self.layers
        if not bases:
            return [""] if many or sum(x["rows"] for x in layers) > self.most else []
        large = set(self._large(state, bases))
        return [p for p, n in changed.items() if p in large or n and (many or n >= self.share * bases[p]["rows"])]

    def _changed(self, state: dict, parts: Iterable[str]) -> dict[str, int]:
        """How many rows layers hold of each part that its base has not taken in."""
        upto, held = _folded(state.get("bases", {})), [0] * SLOTS
        for x in state.get("layers", []):
            for s, n in x["slots"].items():
                held[int(s)] += n if x["number"] > upto[int(s)] else 0
        return {p: sum(held[s] for s in _inside(p)) for p in parts}

    def _large(self, state: dict, parts: Iterable[str]) -> list[str]:
        """The parts that may have more than `most` rows, layers counted, and can still be split."""
        bases, changed = state.get("bases", {}), self._changed(state, parts)
        return [p for p, n in changed.items() if len(p) < SLOT_BITS and n + (bases[p]["rows"] if p in bases else 0) > self.most]

    def fold(self, parts: list[str] | None = None, keep: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Write the parts that are due (or given) anew with their layers; keep may drop rows of a log that nobody needs."""
        at = self.head()
        parts = self.due(at.state) if parts is None else parts
        if not parts:
            return
        upto = at.state["last"]

        def rows_of(some: list[str]) -> DataFrame:
            rows = self.read(at, {s for p in some for s in _inside(p)})
            return keep(rows) if keep else rows

        # Only parts that a split may concern are counted before; the rest is once it is written.
        large = self._large(at.state, parts)
        sizes = [0] * SLOTS
        if large:
            for r in rows_of(large).groupBy(slot_of(self.key).alias("slot")).agg(F.count("*").alias("n")).collect():
                sizes[r["slot"]] = r["n"]
        made: list[str] = []
        todo = list(parts)
        while todo:
            part = todo.pop()
            split = len(part) < SLOT_BITS and sum(sizes[s] for s in _inside(part)) > self.most
            (todo.extend((part + "0", part + "1")) if split else made.append(part))
        place, rows = uuid.uuid4().hex, rows_of(parts)
        if len(made) == 1:
            places = {made[0]: place}
            rows.write.parquet(f"{self.root}/rows/{place}")
            counts = {made[0]: self._at([place]).count()}
        else:
            of = {s: part for part in made for s in _inside(part)}
            places = {p: f"{place}/part={p}" for p in made}
            rows = rows.withColumn("part", _by_slot(self.key, (of.get(s, "") for s in range(SLOTS))))
            rows.hint("rebalance", "part").write.partitionBy("part").parquet(f"{self.root}/rows/{place}")
            stored = self.spark.read.schema(rows.schema).parquet(f"{self.root}/rows/{place}")
            counts = {r["part"]: r["n"] for r in stored.groupBy("part").agg(F.count("*").alias("n")).collect()}
        bases = {p: {"place": places[p], "upto": upto, "rows": counts.get(p, 0)} for p in made}
        folded = {p: at.state.get("bases", {}).get(p) for p in parts}

        def build(state: dict, commit: int) -> dict:
            left = {p: b for p, b in state.get("bases", {}).items() if p not in folded}
            gone = any(state.get("bases", {}).get(p) != b for p, b in folded.items() if b)
            if gone or {x["number"] for x in at.state["layers"]} - {x["number"] for x in state["layers"]}:
                return state | {"touched": []}  # another fold came first, or a layer was replaced: this one is not used
            all_ = left | bases
            upto_of = _folded(all_)
            kept = [x for x in state["layers"] if any(upto_of[int(s)] < x["number"] for s in x["slots"])]
            past = [*state.get("past", []), *[x for x in state["layers"] if x not in kept]]
            known = max([state.get("known", 0), *[x["commit"] for x in past[: -2 * self.layers]]])
            return {"known": known, "past": past[-2 * self.layers :], "bases": all_, "layers": kept, "last": state["last"], "touched": []}

        self.log.append(build, at, set())

    def retire(self, keep: int = 2) -> None:
        """Remove commits but the newest `keep`, and rows that none of those has; for a time without writers."""
        self.log.retire(keep)
        used = set()
        for number in self.log.numbers():
            if found := self.log.at(number):
                used |= {b["place"] for b in found.state.get("bases", {}).values()} | {x["place"] for x in self._since(found, -1)}
        for name in child_names(self.spark, f"{self.root}/rows"):
            if name not in {u.split("/")[0] for u in used}:
                remove(self.spark, f"{self.root}/rows/{name}")
            else:
                for part in child_names(self.spark, f"{self.root}/rows/{name}"):
                    if part.startswith("part=") and f"{name}/{part}" not in used:
                        remove(self.spark, f"{self.root}/rows/{name}/{part}")
