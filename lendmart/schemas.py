"""Fixed names, schemas and constraints of the lending warehouse."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


LONG, TEXT, INSTANT = T.LongType(), T.StringType(), T.TimestampNTZType()

# --- fixed values: table layouts, in column order ---------------------------
USERS = _schema(
    user_id=LONG, name=TEXT, email=TEXT, address=TEXT, gender=TEXT, created_at=INSTANT
)
BOOKS = _schema(
    book_id=LONG, title=TEXT, author=TEXT, book_type=TEXT, genre=TEXT,
    publisher=TEXT, release_year=LONG, stock=LONG, created_at=INSTANT,
)
RENTS = _schema(
    rent_id=LONG, user_id=LONG, book_id=LONG,
    rent_date=INSTANT, return_date=INSTANT, created_at=INSTANT,
)
TABLES = {"users": USERS, "books": BOOKS, "rents": RENTS}
KEYS = {"users": "user_id", "books": "book_id", "rents": "rent_id"}
TIMESTAMP_COLUMNS = ("rent_date", "return_date", "created_at")

# --- fixed values: categories ------------------------------------------------
GENDERS = ("Male", "Female")
BOOK_TYPES = ("Novel", "Comic", "Biography", "Encyclopedia", "Magazine")
GENRES = ("Fiction", "Non-Fiction", "Mystery", "Thriller", "Romance", "Technology")

# --- fixed values: labels of the ten published metrics ------------------------
METRIC_LABELS = (
    "Jumlah Akumulasi Peminjam - orang",
    "Jumlah Peminjam Aktif-orang",
    "Jumlah Peminjam Perorangan - Tahun Berjalan",
    "Total Pinjaman Yang Sudah Disalurkan",
    "Akumulasi Pinjaman Tahun ini",
    "Akumulasi Pinjaman Posisi Akhir Bulan",
    "Total Outstanding Pinjaman",
    "Jumlah Akumulasi Pemberi Dana",
    "Jumlah Akumulasi Pemberi Dana Tahun Berjalan",
    "Jumlah Akumulasi Pemberi Dana Posisi Akhir Bulan",
)
METRICS = T.StructType(
    [T.StructField(label, LONG) for label in METRIC_LABELS]
    + [T.StructField("created_at", INSTANT)]
)

# Logical source name -> physical table.
SOURCES = {"users_data": "users", "books_data": "books", "rents_data": "rents"}

# Layer -> database. A custom name is used as it is; a layer without one falls
# back to the default database (see ``layer_name``).
DEFAULT_DATABASE = "lendmart"
LAYERS = {
    "warehouse": None,
    "preparation": "lendmart_preparation",
    "dimfact": "lendmart_dimfact",
    "datamart": "lendmart_marts",
}

# Constraints the operational database declares; the warehouse only reports them.
CONSTRAINTS = {
    "users": {
        "key": "user_id",
        "required": ("name", "email"),
        "unique": ("email",),
        "max_length": {"name": 100, "email": 100, "gender": 10},
    },
    "books": {
        "key": "book_id",
        "required": ("title", "author", "stock"),
        "unique": (),
        "max_length": {
            "title": 255, "author": 100, "book_type": 100, "genre": 100, "publisher": 100,
        },
    },
    "rents": {
        "key": "rent_id",
        "required": ("user_id", "book_id"),
        "unique": (),
        "max_length": {},
    },
}


def layer_name(layer: str, layers: dict[str, str | None] = LAYERS,
               default: str = DEFAULT_DATABASE) -> str:
    """Database of a layer: its custom name verbatim, else the default one."""
    custom = layers.get(layer)
    return default if custom is None else custom.strip()
