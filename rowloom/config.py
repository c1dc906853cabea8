"""Settings of one normalization run."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column

# Kinds of metadata a package can hold, with the file-name word of each.
STANDARD_SELECTION = "STANDARD_SELECTION"
LOCAL_REF = "LOCAL_REF"
CUSTOMIZATION = "CUSTOMIZATION"
RELATIONSHIPS = "RELATIONSHIPS"


@dataclass(frozen=True)
class PackageConfig:
    """Where a package lies and how strictly it is read.

    ``record_id`` maps a flat record body to the record-id column, for
    applications whose key is not the first ``c1``.  ``check_contents`` turns
    the pass that checks every file for well-formedness on or off.
    ``broadcast_limit_bytes`` bounds the field catalog that is sent to every
    executor; a larger catalog is joined by shuffle instead.
    """

    package_root: str

    data_dir: str = "data"
    metadata_dir: str = "metadata"
    local_ref_dir: str = "local_ref"
    customization_dir: str = "customization"
    relationships_dir: str = "relationships"
    xsd_dir: str = "xsd"

    require_xsd: bool = False
    require_standard_selection: bool = True
    require_local_ref_when_declared: bool = True
    require_relationships: bool = False
    fail_on_unmapped_field: bool = False

    local_ref_base_positions: tuple[str, ...] = ("64",)
    output_unknown_fields: bool = True

    record_id: Callable[[Column], Column] | None = None
    check_contents: bool = True
    encoding: str = "UTF-8"
    broadcast_limit_bytes: int = 64 * 1024 * 1024

    @property
    def root(self) -> str:
        """The package's path as its files are named after reading: without the scheme ``file:``, others stay."""
        return re.sub(r"^file:/+", "/", str(self.package_root)).rstrip("/")

    def path(self, directory: str) -> str:
        return f"{self.root}/{directory}"

    @property
    def data_path(self) -> str:
        return self.path(self.data_dir)

    @property
    def xsd_path(self) -> str:
        return self.path(self.xsd_dir)

    def kind_path(self, kind: str) -> str:
        return self.path(
            {
                STANDARD_SELECTION: self.metadata_dir,
                LOCAL_REF: self.local_ref_dir,
                CUSTOMIZATION: self.customization_dir,
                RELATIONSHIPS: self.relationships_dir,
            }[kind]
        )
