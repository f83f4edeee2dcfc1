"""Declarative entity and fact specs.

One ``EntitySpec`` drives staging, link unnesting, snapshots, dimensions, dead letters
and generated checks for an entity, so each model is a spec entry rather than a job.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Attr:
    """A scalar attribute read from the payload.

    kind: ``text``  -> ``payload->>key``, trimmed in staging
          ``date``  -> long-form date text, parsed to DATE in staging and dimension
          ``json``  -> ``payload->key`` (JSON text; a JSON null stays ``null``)
    staged: staged column name; dim: dimension column name (None = not in the dim)
    """

    key: str
    kind: str = "text"
    staged: str | None = None
    dim: str | None = None
    snapshot_kind: str | None = None  # kind used in the snapshot (defaults to text)


@dataclass(frozen=True)
class Link:
    """A JSON array of URLs whose last path segment is another entity's id."""

    key: str
    target: str
    staged: str
    url_col: str
    id_col: str
    dead_letter: bool = True


@dataclass(frozen=True)
class EntitySpec:
    name: str                      # source name, e.g. "bosses"
    prefix: str                    # column prefix, e.g. "boss" -> boss_id, boss_name
    attrs: tuple[Attr, ...] = ()
    links: tuple[Link, ...] = ()
    required: tuple[str, ...] = ("id", "name")
    key: str = "id"
    name_key: str = "name"
    json_check_links: bool = True  # link arrays are snapshot check columns (as JSON)

    @property
    def id_col(self) -> str:
        return f"{self.prefix}_id"

    @property
    def name_col(self) -> str:
        return f"{self.prefix}_name"

    @property
    def sk_col(self) -> str:
        return f"{self.prefix}_sk"

    def link(self, key: str) -> Link:
        for lk in self.links:
            if lk.key == key:
                return lk
        raise KeyError(f"{self.name} has no link field {key!r}")

    def snapshot_columns(self) -> list[tuple[str, str]]:
        """(key, kind) of the snapshot's check columns, in order (id excluded)."""
        cols = [(self.name_key, "text")]
        cols += [(a.key, a.snapshot_kind or "text") for a in self.attrs]
        if self.json_check_links:
            cols += [(lk.key, "json") for lk in self.links]
        return cols


@dataclass(frozen=True)
class FactSpec:
    name: str
    entity: str                  # entity holding the link array (left side)
    link: str                    # link key on that entity
    versions: str = "current"    # "current": join only is_current versions; "all": every version
    left_extras: tuple[str, ...] = ()
    right_extras: tuple[str, ...] = ()


@dataclass(frozen=True)
class Catalog:
    entities: tuple[EntitySpec, ...]
    facts: tuple[FactSpec, ...] = field(default=())

    def entity(self, name: str) -> EntitySpec:
        for e in self.entities:
            if e.name == name:
                return e
        raise KeyError(name)
