"""Declared schemas; table DDL and document mappings are derived from them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STRING, DOUBLE, INT, LONG = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


def all_strings(names) -> T.StructType:
    return T.StructType([T.StructField(name, STRING, True) for name in names])


# --- fixed values: column headings of the public input files ---------------
TRANSACTION_HEADINGS = {
    "id_disposition": "No disposition",
    "nature_mutation": "Nature mutation",
    "date": "Date mutation",
    "value": "Valeur fonciere",
    "department": "Code departement",
    "commune": "Code commune",
    "nom_commune": "Commune",
    "code_postal": "Code postal",
    "type_local": "Type local",
    "surface": "Surface reelle bati",
    "rooms": "Nombre pieces principales",
    "land": "Surface terrain",
}
GEOGRAPHY_HEADINGS = {
    "code_commune": "code_commune_INSEE",
    "nom_commune_insee": "nom_commune_postal",
    "departement": "code_departement",
    "latitude": "latitude",
    "longitude": "longitude",
}
ESTABLISHMENT_HEADINGS = {
    "siret": "siret",
    "code_commune": "codeCommuneEtablissement",
    "nom_commune": "libelleCommuneEtablissement",
    "code_postal": "codePostalEtablissement",
    "code_naf": "activitePrincipaleEtablissement",
    "etat": "etatAdministratifEtablissement",
    "date_creation": "dateCreationEtablissement",
    "tranche_effectifs": "trancheEffectifsEtablissement",
    "est_siege": "etablissementSiege",
    "est_employeur": "caractereEmployeurEtablissement",
}
# --- end of fixed values ---------------------------------------------------

TRANSACTIONS = struct(
    id_disposition=STRING, nature_mutation=STRING, date_mutation=T.DateType(),
    mois=INT, valeur_fonciere=DOUBLE, code_commune=STRING, nom_commune=STRING,
    code_postal=STRING, type_local=STRING, surface_bati=DOUBLE, nb_pieces=INT,
    surface_terrain=DOUBLE, prix_m2=DOUBLE, code_departement=STRING, annee=INT,
)

GEOGRAPHY = struct(
    code_commune=STRING, nom_commune_insee=STRING, departement=STRING,
    latitude=DOUBLE, longitude=DOUBLE,
)

ACTIVE_PROFILE = struct(
    code_commune=STRING, nb_entreprises_actives=LONG, diversite_sectorielle=LONG,
    nb_entreprises_immobilier=LONG, nb_entreprises_construction=LONG,
    nb_entreprises_tech=LONG, nb_entreprises_commerce=LONG,
)

CREATIONS = struct(
    code_commune=STRING, annee=INT, nb_creations_annee=LONG,
    nb_creations_tech=LONG, nb_creations_construction=LONG,
)

PARTITION_KEYS = ("code_departement", "annee")


def _joined(*parts: T.StructType) -> T.StructType:
    seen: dict[str, T.StructField] = {}
    for part in parts:
        for field in part.fields:
            seen.setdefault(field.name, field)
    keys = [seen.pop(key) for key in PARTITION_KEYS]
    return T.StructType([*seen.values(), *keys])


ENRICHED = _joined(
    TRANSACTIONS, GEOGRAPHY, ACTIVE_PROFILE, CREATIONS,
    struct(taux_creation_entreprises=DOUBLE),
)
ENRICHED_V2 = _joined(
    ENRICHED, struct(qualite_donnee=STRING, categorie_prix=STRING, zone_idf=STRING)
)

GEO_POINT = struct(lat=DOUBLE, lon=DOUBLE)

SALE_DOCUMENT = T.StructType(
    [ENRICHED[name] for name in (
        "code_commune", "nom_commune", "code_departement", "type_local", "annee",
        "mois", "date_mutation", "valeur_fonciere", "prix_m2", "surface_bati",
        "nb_pieces", "nb_entreprises_actives", "diversite_sectorielle",
        "nb_creations_annee", "taux_creation_entreprises", "latitude", "longitude",
    )] + [T.StructField("location", GEO_POINT, True)]
)

# fixed values: fields of the energy messages
ENERGY_MEASURES = (
    "consommation", "production", "thermique", "nucleaire", "eolien", "solaire",
    "hydraulique", "pompage", "bioenergies", "ech_physiques", "taux_co2",
)
ENERGY_FIELDS = ("date_heure", "libelle_region", "code_insee_region", *ENERGY_MEASURES)
ENERGY_DOCUMENT = T.StructType(
    [
        T.StructField("date_heure", T.TimestampType()),
        T.StructField("ingestion_timestamp", T.TimestampType()),
        T.StructField("libelle_region", STRING),
        T.StructField("code_insee_region", STRING),
    ]
    + [T.StructField(name, DOUBLE) for name in ENERGY_MEASURES]
)

LOG_EVENT = T.StructType([
    T.StructField("@timestamp", T.TimestampType()),
    T.StructField("message", STRING),
    T.StructField("host", struct(name=STRING)),
    T.StructField("level", STRING),
    T.StructField("log", struct(file=struct(path=STRING))),
])


@dataclass(frozen=True)
class TableSpec:
    """A warehouse table: name, full schema, partition columns, location."""

    database: str
    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    path: str

    @property
    def qualified(self) -> str:
        return f"`{self.database}`.`{self.name}`"

    def ddl(self, if_absent: bool = False) -> str:
        columns = ", ".join(
            f"`{field.name}` {field.dataType.simpleString()}" for field in self.schema.fields
        )
        partitioned = ""
        if self.keys:
            partitioned = f"PARTITIONED BY ({', '.join(f'`{key}`' for key in self.keys)}) "
        guard = "IF NOT EXISTS " if if_absent else ""
        location = self.path.replace("'", "\\'")
        return (
            f"CREATE TABLE {guard}{self.qualified} ({columns}) USING PARQUET "
            f"{partitioned}LOCATION '{location}'"
        )


def document_mapping(schema: T.StructType, full_text: tuple[str, ...] = ()) -> dict:
    """Typed mapping of a document collection, derived from its schema."""
    names = {
        "string": "keyword", "int": "integer", "bigint": "long", "double": "double",
        "date": "date", "timestamp": "date", "timestamp_ntz": "date", "boolean": "boolean",
    }
    properties = {}
    for field in schema.fields:
        if field.dataType == GEO_POINT:
            kind = "geo_point"
        elif field.name in full_text:
            kind = "text"
        elif isinstance(field.dataType, T.StructType):
            properties[field.name] = document_mapping(field.dataType, full_text)["mappings"]
            continue
        else:
            kind = names[field.dataType.simpleString()]
        properties[field.name] = {"type": kind}
    return {"mappings": {"properties": properties}}
