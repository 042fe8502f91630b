"""The fifteen entities: columns, rules, keys and references, declared once.

Everything else (read schemas, cleaning rules, key columns, load shapes,
integrity checks) is derived from this table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Fixed values of the model.
LIFECYCLE = ("archived", "deprecated", "quarantined")
HASH_ALGORITHMS = ("SHA256", "MD5", "BLAKE2b-256")

_TYPES = {
    "string": T.StringType(),
    "stamp": T.StringType(),
    "bool": T.BooleanType(),
    "long": T.LongType(),
}


@dataclass(frozen=True)
class Col:
    """One column: ``kind`` says what to do with over-long text, drop (identifier) or cut (descriptive)."""

    name: str
    type: str = "string"
    required: bool = False
    max_length: int | None = None
    kind: str | None = None
    allowed: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Ref:
    """Reference to a parent entity by natural key columns of this entity."""

    columns: tuple[str, ...]
    parent: str
    optional: bool = False


@dataclass(frozen=True)
class Entity:
    name: str
    columns: tuple[Col, ...]
    key: tuple[str, ...]
    refs: tuple[Ref, ...] = ()
    folded: tuple[str, ...] = ()
    first_wins: bool = False
    surrogate: str | None = None

    def column(self, name: str) -> Col:
        return next(c for c in self.columns if c.name == name)

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns)

    def schema(self, as_text: bool = False) -> T.StructType:
        """Natural-key row schema; ``as_text`` reads every field as string."""
        return T.StructType(
            [T.StructField(c.name, T.StringType() if as_text else _TYPES[c.type]) for c in self.columns]
        )


def must(name: str, type: str = "string", **kw) -> Col:
    return Col(name, type, required=True, **kw)


def may(name: str, type: str = "string", **kw) -> Col:
    return Col(name, type, **kw)


def ident(limit: int) -> dict:
    return {"max_length": limit, "kind": "identifier"}


def prose(limit: int) -> dict:
    return {"max_length": limit, "kind": "descriptive"}


_PACKAGE = Ref(("package_name",), "package")
_RELEASE = Ref(("package_name", "version"), "release")
_FILE = Ref(("package_name", "version", "filename"), "release_file")
_REL_COLS = (must("package_name"), must("version"))
_FILE_COLS = (*_REL_COLS, must("filename"))

# Names, order, limits and rules of the columns are those of the relational model.
_ALL = (
    Entity(
        "package",
        (must("name"), may("lifecycle_status", allowed=LIFECYCLE), may("organization_owner")),
        key=("name",),
        refs=(Ref(("organization_owner",), "organization", optional=True),),
        first_wins=True,
        surrogate="package_id",
    ),
    Entity(
        "organization",
        (must("name"), must("display_name", **prose(255))),
        key=("name",),
        first_wins=True,
        surrogate="organization_id",
    ),
    Entity(
        "maintainer",
        (must("username", **ident(50)), may("joined_at", "stamp")),
        key=("username",),
        folded=("username",),
        first_wins=True,
        surrogate="maintainer_id",
    ),
    Entity(
        "maintained_by",
        (must("package_name"), must("maintainer_username", **ident(50))),
        key=("package_name", "maintainer_username"),
        refs=(_PACKAGE, Ref(("maintainer_username",), "maintainer")),
        folded=("maintainer_username",),
        first_wins=True,
    ),
    Entity(
        "release",
        (
            *_REL_COLS,
            must("created", "stamp"),
            must("is_prerelease", "bool"),
            must("yanked", "bool"),
            may("lifecycle_status", allowed=LIFECYCLE),
            may("yanked_reason"),
            may("summary", **prose(512)),
            may("license"),
            may("requires_python"),
        ),
        key=("package_name", "version"),
        refs=(_PACKAGE,),
        surrogate="release_id",
    ),
    Entity(
        "release_detail",
        (
            *_REL_COLS,
            may("description"),
            may("meta_author"),
            may("meta_author_email"),
            may("meta_author_email_verified", "bool"),
            may("meta_maintainer"),
            may("meta_maintainer_email"),
            may("meta_maintainer_email_verified", "bool"),
        ),
        key=("package_name", "version"),
        refs=(_RELEASE,),
    ),
    Entity(
        "release_file",
        (
            *_FILE_COLS,
            must("path"),
            must("size", "long"),
            must("upload_time", "stamp"),
            must("is_trusted_publishing", "bool"),
            may("uploaded_via", **prose(255)),
            may("packagetype"),
        ),
        key=("package_name", "version", "filename"),
        refs=(_RELEASE,),
        surrogate="release_file_id",
    ),
    Entity(
        "file_hash",
        (*_FILE_COLS, must("algorithm", allowed=HASH_ALGORITHMS), must("digest", **ident(64))),
        key=("package_name", "version", "filename", "algorithm"),
        refs=(_FILE,),
    ),
    Entity(
        "project_link",
        (*_REL_COLS, must("label"), must("url"), must("verified", "bool")),
        key=("package_name", "version", "label"),
        refs=(_RELEASE,),
        folded=("label",),
    ),
    Entity(
        "classifier",
        (must("category", **ident(50)), must("value", **ident(255))),
        key=("category", "value"),
        first_wins=True,
        surrogate="classifier_id",
    ),
    Entity(
        "tagged_with",
        (*_REL_COLS, must("category"), must("value")),
        key=("package_name", "version", "category", "value"),
        refs=(_RELEASE, Ref(("category", "value"), "classifier")),
    ),
    Entity(
        "release_keyword",
        (*_REL_COLS, must("keyword", **prose(100))),
        key=("package_name", "version", "keyword"),
        refs=(_RELEASE,),
    ),
    Entity(
        "release_extra",
        (*_REL_COLS, must("extra_name", **ident(100))),
        key=("package_name", "version", "extra_name"),
        refs=(_RELEASE,),
    ),
    Entity(
        "release_file_tag",
        (*_FILE_COLS, must("wheel_tag", **prose(100))),
        key=("package_name", "version", "filename", "wheel_tag"),
        refs=(_FILE,),
    ),
    Entity(
        "attestation",
        (
            *_FILE_COLS,
            must("sigstore_log_index", "long"),
            must("integration_time", "stamp"),
            must("statement_type", **ident(255)),
            must("predicate_type", **ident(255)),
            must("subject_name", **ident(255)),
            must("subject_digest", **ident(64)),
            may("source_repo"),
            may("source_reference", **ident(255)),
            must("token_issuer", **ident(255)),
            may("runner_environment", **ident(50)),
            may("publisher_workflow", **ident(255)),
            may("trigger_event", **ident(50)),
        ),
        key=("sigstore_log_index",),
        refs=(_FILE,),
    ),
)

ENTITIES: dict[str, Entity] = {e.name: e for e in _ALL}
