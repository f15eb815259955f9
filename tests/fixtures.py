"""Index definitions used by several tests."""

import json


def field(name, kind, key=False, dimensions=None, profile=None, fields=None, **flags):
    return {"name": name, "type": kind, "key": key, "dimensions": dimensions, "vectorSearchProfile": profile,
            "fields": fields, **flags}


RECIPES = {  # a plain key, one vector field, the algorithm named as the service does
    "name": "recipes",
    "fields": [
        field("flavour", "Collection(Edm.Single)", dimensions=96, profile="flavours"),
        field("recipe_no", "Edm.String", key=True), field("heading", "Edm.String", searchable=True, filterable=True),
        field("minutes", "Edm.Int32", sortable=True), field("vegan", "Edm.Boolean"),
        field("allergens", "Collection(Edm.String)", facetable=True),
    ],
    "vectorSearch": {
        "algorithms": [{"name": "by-flavour", "kind": "hnsw",
                        "hnswParameters": {"m": 12, "efConstruction": 120, "efSearch": 60, "metric": "dotProduct"}}],
        "profiles": [{"name": "flavours", "algorithmConfigurationName": "by-flavour"}],
    },
}
SIGHTINGS = {  # many types, a number key, two profiles one of which is exhaustive, features without a counterpart
    "name": "bird-sightings-eu",
    "fields": [
        field("sighting", "Edm.Int64", key=True), field("seen_at", "Edm.DateTimeOffset", sortable=True),
        field("place", "Edm.GeographyPoint"), field("altitude", "Edm.Double"), field("flock", "Edm.Int16"),
        field("certainty", "Edm.Byte"), field("species", "Edm.String", facetable=True),
        field("observer", "Edm.String", fields=[{"name": "first", "type": "Edm.String"}, {"name": "club", "type": "Edm.String"}]),
        field("ring_numbers", "Collection(Edm.Int64)"), field("weights", "Collection(Edm.Double)"),
        field("remarks", "Collection(Edm.String)"),
        field("song", "Collection(Edm.Half)", dimensions=40, profile="songs"),
        field("plumage", "Collection(Edm.SByte)", dimensions=20, profile="looks"),
        field("pattern", "Collection(Edm.Byte)", dimensions=44, profile="nowhere"),
    ],
    "vectorSearch": {
        "algorithms": [
            {"name": "all-songs", "kind": "exhaustiveKnn", "exhaustiveKnnParameters": {"metric": "euclidean"}},
            {"name": "looks-graph", "kind": "hnsw", "hnswParameters": {"m": 24, "efConstruction": 90, "metric": "euclidean"}},
        ],
        "profiles": [{"name": "looks", "algorithm": "looks-graph"}, {"name": "songs", "algorithm": "all-songs"}],
    },
    "scoringProfiles": [{"name": "rare-first"}], "suggesters": [{"name": "by-species"}],
    "semantic": {"configurations": [{"name": "field-notes"}]},
}
PARTS_EXPORT = {  # the algorithm named as the export does
    "name": "spare_parts",
    "fields": [
        field("part", "Edm.String", key=True), field("shape", "Collection(Edm.Single)", dimensions=33, profile="p"),
    ],
    "vectorSearch": {
        "algorithms": [{"name": "g", "kind": "hnsw", "hnswParameters": {"m": 6, "efConstruction": 70, "efSearch": 31, "metric": "hamming"}}],
        "profiles": [{"name": "p", "algorithm": "g"}],
    },
}
FIELDLESS = {"name": "announced", "fields": [], "suggesters": [{"name": "later"}]}
NO_OVERRIDES = (
    "index_name string, field_name string, excluded boolean, target_name string, max_length int, max_capacity int, "
    "is_partition_key boolean"
)


def write_definitions(folder, *definitions):
    for number, definition in enumerate(definitions):
        (folder / f"index{number}.json").write_text(json.dumps(definition, indent=2))
    return str(folder)
