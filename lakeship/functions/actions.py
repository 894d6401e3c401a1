"""Schemas of the commit log and of a bundle, and columns derived from actions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

from lakeship.functions import paths


def struct_type(**fields: DataType) -> StructType:
    """A struct of nullable fields; needs no session, unlike a DDL string."""
    return StructType([StructField(name, kind) for name, kind in fields.items()])


STRING, LONG, INT, FLAG = StringType(), LongType(), IntegerType(), BooleanType()
PAIRS = MapType(STRING, STRING)

VECTOR = struct_type(
    storageType=STRING,
    pathOrInlineDv=STRING,
    offset=INT,
    sizeInBytes=INT,
    cardinality=LONG,
    dvFile=STRING,
    storagePath=STRING,
)
ACTION_SCHEMA = struct_type(
    txn=struct_type(appId=STRING, version=LONG, lastUpdated=LONG),
    add=struct_type(
        path=STRING,
        partitionValues=PAIRS,
        size=LONG,
        modificationTime=LONG,
        dataChange=FLAG,
        stats=STRING,
        tags=PAIRS,
        deletionVector=VECTOR,
        deletionVectorDescriptor=struct_type(format=STRING, numRows=INT, storagePath=STRING),
    ),
    remove=struct_type(
        path=STRING,
        deletionTimestamp=LONG,
        dataChange=FLAG,
        extendedFileMetadata=FLAG,
        partitionValues=PAIRS,
        size=LONG,
        deletionVector=VECTOR,
    ),
    metaData=struct_type(
        id=STRING,
        name=STRING,
        description=STRING,
        format=struct_type(provider=STRING, options=PAIRS),
        schemaString=STRING,
        partitionColumns=ArrayType(STRING),
        configuration=PAIRS,
        createdTime=LONG,
    ),
    protocol=struct_type(
        minReaderVersion=INT,
        minWriterVersion=INT,
        readerFeatures=ArrayType(STRING),
        writerFeatures=ArrayType(STRING),
    ),
    domainMetadata=struct_type(domain=STRING, configuration=STRING, removed=FLAG),
    cdc=struct_type(path=STRING, partitionValues=PAIRS, size=LONG, dataChange=FLAG),
    commitInfo=struct_type(timestamp=LONG, operation=STRING),
)
STATE_ACTIONS = ("txn", "add", "remove", "metaData", "protocol", "domainMetadata")

BUNDLE_SCHEMA = struct_type(
    tablePath=STRING, tableName=STRING, fromVersion=LONG, toVersion=LONG, exportTimestamp=STRING
)


def vector_id(vector: Column) -> Column:
    """Identity of a deletion vector, '' for none; part of the replay key."""
    offset = F.coalesce(F.concat(F.lit("@"), vector["offset"].cast("string")), F.lit(""))
    return F.coalesce(
        F.concat(vector["storageType"], vector["pathOrInlineDv"], offset),
        vector["dvFile"],
        vector["storagePath"],
        F.lit(""),
    )


def vector_files(vector: Column) -> Column:
    """Files that hold a deletion vector; both the current and the older field names."""
    return F.filter(
        F.array(
            paths.dv_relative_path(vector["storageType"], vector["pathOrInlineDv"]),
            paths.blank_to_null(paths.decode_path(vector["dvFile"])),
            paths.blank_to_null(paths.decode_path(vector["storagePath"])),
        ),
        lambda path: path.isNotNull(),
    )
