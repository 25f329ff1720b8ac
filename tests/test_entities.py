import pytest

from changeloom.entities import ENTITIES, ENVELOPE, PRODUCTS, SHIPPINGS, TRANSACTIONS, USERS

# Names and order of the columns are the data contract.
COLUMNS = {
    "transactions": [
        "transaction_id", "user_id", "product_id", "payment_id", "shipping_id",
        "quantity", "discount", "last_modified_ts", "status",
    ],
    "users": [
        "user_id", "full_name", "phone_number", "sex", "address", "birthdate",
        "email", "job", "last_modified_ts", "status",
    ],
    "products": [
        "product_id", "product_name", "category", "unit_price", "merchant_name",
        "rating", "last_modified_ts", "status",
    ],
    "payments": ["payment_id", "payment_method", "currency", "last_modified_ts", "status"],
    "shippings": [
        "shipping_id", "shipping_address", "shipping_cost", "shipping_status",
        "status", "last_modified_ts",
    ],
}


@pytest.mark.parametrize("name", COLUMNS)
def test_schema_names_and_order(name):
    schema = ENTITIES[name].schema
    assert schema.fieldNames() == COLUMNS[name]
    assert all(field.nullable for field in schema)
    assert ENTITIES[name].key == COLUMNS[name][0]


def test_types():
    kinds = {f.name: f.dataType.simpleString() for f in TRANSACTIONS.schema}
    assert kinds["quantity"] == kinds["discount"] == "int"
    kinds = {f.name: f.dataType.simpleString() for f in PRODUCTS.schema}
    assert kinds["unit_price"] == kinds["rating"] == "float"


def test_envelope():
    assert ENVELOPE.simpleString() == "struct<payload:struct<after:string>>"


def test_serving_schema_roles():
    assert "shipping_status" not in SHIPPINGS.serving_schema.fieldNames()
    assert SHIPPINGS.serving_schema["date"].dataType.simpleString() == "string"
    assert USERS.serving_schema.fieldNames() == [
        "user_id", "full_name", "phone_number", "sex", "address", "email", "job", "status",
        "birthdate", "last_modified_ts", "date",
    ]


def test_only_keeps_key_and_time():
    narrow = TRANSACTIONS.only("quantity")
    assert list(narrow.columns) == ["transaction_id", "quantity", "last_modified_ts"]
    assert narrow.metrics == ("quantity",)
    with pytest.raises(ValueError):
        TRANSACTIONS.only("no_such_column")


def test_retention():
    kept = {name: entity.retention_days for name, entity in ENTITIES.items()}
    assert kept == {
        "users": None, "products": None, "payments": None, "transactions": 3, "shippings": 3,
    }
