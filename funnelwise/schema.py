"""Table schemas and the constants every operator agrees on."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
PERCENT = T.DecimalType(5, 2)
EXTRA_NUMBER = T.DecimalType(18, 4)

_TEXT, _ID, _TIME = T.StringType(), T.LongType(), T.TimestampType()

# Names, order and types of the published deal table.
BASE_COLUMNS = [
    ("id", _TEXT),
    ("titulo", _TEXT),
    ("creator_user_id", _ID),
    ("creator_user_name", _TEXT),
    ("person_id", _ID),
    ("person_name", _TEXT),
    ("stage_id", _ID),
    ("stage_name", _TEXT),
    ("pipeline_id", _ID),
    ("pipeline_name", _TEXT),
    ("owner_id", _ID),
    ("owner_name", _TEXT),
    ("status", _TEXT),
    ("value", MONEY),
    ("currency", _TEXT),
    ("add_time", _TIME),
    ("update_time", _TIME),
    ("org_id", _ID),
    ("org_name", _TEXT),
    ("lost_reason", _TEXT),
    ("visible_to", _TEXT),
    ("close_time", _TIME),
    ("won_time", _TIME),
    ("lost_time", _TIME),
    ("first_won_time", _TIME),
    ("expected_close_date", T.DateType()),
    ("probability", PERCENT),
    ("label", _TEXT),
    ("local_do_acidente", _TEXT),
    ("local_do_acidente_numero_da_casa", _TEXT),
    ("local_do_acidente_nome_da_rua", _TEXT),
    ("local_do_acidente_distrito_sub_localidade", _TEXT),
    ("local_do_acidente_cidade_municipio_vila_localidade", _TEXT),
    ("local_do_acidente_estado", _TEXT),
    ("local_do_acidente_regiao", _TEXT),
    ("local_do_acidente_pais", _TEXT),
    ("local_do_acidente_cep_codigo_postal", _TEXT),
    ("local_do_acidente_latitude", _TEXT),
    ("local_do_acidente_longitude", _TEXT),
    ("proposta_endereco", _TEXT),
    ("proposta_endereco_numero_da_casa", _TEXT),
    ("proposta_endereco_nome_da_rua", _TEXT),
]
BASE_NAMES = [name for name, _ in BASE_COLUMNS]

# Labels, defaults and prefixes stored in the tables.
UNKNOWN_NAME = "Desconhecido"
INVALID_SLUG = "_invalid_normalized_name"
HISTORY_PREFIX = "moved_to_stage_"
STATUS_LABELS = {"won": "Ganho", "lost": "Perdido", "open": "Em aberto", "deleted": "Deletado"}
FIELD_DEFAULTS = {"titulo": "", "currency": "USD", "lost_reason": "", "visible_to": "", "value": 0}

# Column suffix of each address component.
ADDRESS_SUFFIXES = {
    "street_number": "numero_da_casa",
    "route": "nome_da_rua",
    "sublocality": "distrito_sub_localidade",
    "locality": "cidade_municipio_vila_localidade",
    "admin_area_level_1": "estado",
    "admin_area_level_2": "regiao",
    "country": "pais",
    "postal_code": "cep_codigo_postal",
    "latitude": "latitude",
    "longitude": "longitude",
}
# An object holding any of these keys is an address.
ADDRESS_KEYS = ["formatted_address", "locality", "country", "postal_code"]

# Field keys that belong to the system and are never custom fields.
SYSTEM_FIELD_KEYS = [
    "id", "creator_user_id", "person_id", "org_id", "stage_id", "pipeline_id", "title", "value", "currency", "add_time",
    "update_time", "status", "lost_reason", "visible_to", "close_time", "won_time", "lost_time", "first_won_time",
    "products_count", "files_count", "notes_count", "followers_count", "email_messages_count", "activities_count",
    "done_activities_count", "undone_activities_count", "participants_count", "expected_close_date", "probability",
    "next_activity_date", "next_activity_time", "next_activity_id", "last_activity_id", "last_activity_date",
    "stage_change_time", "last_incoming_mail_time", "last_outgoing_mail_time", "label", "stage_order_nr", "person_name",
    "org_name", "next_activity_subject", "next_activity_type", "next_activity_duration", "next_activity_note",
    "formatted_value", "weighted_value", "formatted_weighted_value", "weighted_value_currency", "rotten_time",
    "owner_name", "cc_email",
]

# Token price of one successful call per endpoint label.
ENDPOINT_COSTS = {
    "/deals/detail/changelog": 20,
    "/dealFields": 20,
    "/users": 20,
    "/users/detail": 5,
    "/deals": 10,
    "/stages": 5,
    "/pipelines": 5,
    "/persons/detail": 1,
    "/persons": 10,
}
DEFAULT_ENDPOINT_COST = 10
DAILY_TOKEN_BUDGET = 1_800_000

# Path words kept in an endpoint label.
SUBRESOURCES = ["changelog", "followers", "activities", "files", "mailMessages", "participants", "products"]
ACTIONS = ["search", "summary", "timeline", "collection", "products", "installments"]

# Upper edges of the duration and size histograms.
RUN_SECONDS_EDGES = [10, 30, 60, 120, 300, 600, 1800, 3600, 7200, 10800]
DB_SECONDS_EDGES = [0.1, 0.5, 1, 5, 10, 30, 60, 120]
BATCH_ROWS_EDGES = [0, 10, 50, 100, 200, 500, 1000, 2000]
API_SECONDS_EDGES = [0.1, 0.5, 1, 2, 5, 10, 20, 30, 45, 60]


def deal_schema(custom_columns=(), history_columns=()) -> T.StructType:
    """Declared deal table: base columns, then custom and stage-history columns by name."""
    fields = [T.StructField(n, t) for n, t in BASE_COLUMNS]
    fields += [T.StructField(n, _TEXT) for n in sorted(set(custom_columns))]
    fields += [T.StructField(n, _TIME) for n in sorted(set(history_columns))]
    return T.StructType(fields)
