"""Entity specifications: which source field becomes which column, and of what type."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

TYPES = {
    "text": T.StringType(),
    "id": T.StringType(),
    "int": T.StringType(),
    "long": T.StringType(),
    "num": T.StringType(),
    "bool": T.BooleanType(),
    "any": T.VariantType(),
}


@dataclass(frozen=True)
class Field:
    """One mapped field. ``kind`` is a key of TYPES; ``num`` is text read leniently as a double,
    ``int`` and ``long`` whole numbers, also if they are sent as text or with a zero fraction, ``any`` keeps the JSON value so that numbers and quoted numbers stay apart."""

    source: str
    column: str
    kind: str = "text"


@dataclass(frozen=True)
class Child:
    """A list of sub-records and the table it becomes."""

    table: str
    parent_fk: str
    natural_key: tuple[str, ...]
    fields: tuple[Field, ...]
    source: str | None = None  # list field of the parent; None = delivered in its own pages
    nested: dict[str, tuple[Field, ...]] = field(default_factory=dict)
    partition_column: str | None = None


@dataclass(frozen=True)
class Entity:
    name: str
    natural_key: tuple[str, ...]
    fields: tuple[Field, ...]
    nested: dict[str, tuple[Field, ...]] = field(default_factory=dict)
    children: dict[str, Child] = field(default_factory=dict)
    required_status: str | None = None
    no_update: tuple[str, ...] = ()
    partition_column: str | None = None

    @property
    def id_column(self) -> str:
        return self.natural_key[0]


def _struct(*groups: tuple[Field, ...], extra: list[T.StructField] = ()) -> T.StructType:
    seen: dict[str, T.DataType] = {}
    for group in groups:
        for f in group:
            seen.setdefault(f.source, TYPES[f.kind])
    return T.StructType([T.StructField(n, t) for n, t in seen.items()] + list(extra))


def child_schema(child: Child) -> T.StructType:
    """Schema of one sub-record as delivered."""
    return _struct(child.fields, extra=[T.StructField(n, _struct(f)) for n, f in child.nested.items()])


def record_schema(entity: Entity) -> T.StructType:
    """Schema of one source record with its objects and lists."""
    objects = [T.StructField(n, _struct(f)) for n, f in entity.nested.items()]
    lists = [
        T.StructField(c.source, T.ArrayType(child_schema(c))) for c in entity.children.values() if c.source
    ]
    status = [T.StructField("status", T.StringType())] if entity.required_status else []
    schema = _struct(entity.fields, extra=objects + lists)
    return schema if "status" in schema.names else T.StructType(schema.fields + status)


# Source fields, target columns and keys of every entity ----------------------------

PROPERTY_PHOTOS = Child(
    "property_photos", "property_pk", ("photo_id", "property_pk"),
    (
        Field("id", "photo_id", "id"),
        Field("caption", "caption"),
        Field("default", "is_default", "bool"),
        Field("original_url", "original_url"),
        Field("url", "url"),
    ), source="photos",
)
PROPERTY_CONTACTS = Child(
    "property_contacts", "property_pk", ("property_pk", "contact_id"),
    (
        Field("id", "contact_id", "id"),
        Field("type", "contact_type"),
        Field("name", "name"),
        Field("email", "email"),
        Field("phone", "phone"),
    ),
)
RESERVATION_GUESTS = Child(
    "reservation_guests", "reservation_pk", ("reservation_pk", "guest_name", "guest_email"),
    (
        Field("name", "guest_name"),
        Field("email", "guest_email"),
        Field("phone", "guest_phone"),
        Field("primary", "is_primary", "bool"),
    ), source="guests",
)
TASK_CHILDREN = {
    "assignments": Child(
        "task_assignments", "task_pk", ("task_pk", "assignee_id"),
        (
            Field("assignee_id", "assignee_id", "id"),
            Field("name", "assignee_name"),
            Field("assigned_at", "assigned_at"),
        ), source="assignments",
    ),
    "photos": Child(
        "task_photos", "task_pk", ("task_pk", "photo_id"),
        (
            Field("id", "photo_id", "id"),
            Field("url", "url"),
            Field("caption", "caption"),
            Field("uploaded_at", "uploaded_at"),
        ), source="photos",
    ),
    "comments": Child(
        "task_comments", "task_pk", ("comment_id", "region_code"),
        (
            Field("id", "comment_id", "id"),
            Field("comment", "comment"),
            Field("created_at", "created_at"),
            Field("updated_at", "updated_at"),
        ),
        nested={"author": (Field("id", "author_id", "id"), Field("name", "author_name"))},
    ),
    "requirements": Child(
        "task_requirements", "task_pk", ("task_pk", "requirement_id"),
        (
            Field("id", "requirement_id", "id"),
            Field("section_name", "section_name"),
            Field("action", "action", "any"),
            Field("response", "response"),
            Field("type", "type_requirement"),
            Field("photo_required", "photo_required", "bool"),
            Field("photos", "photos", "any"),
            Field("note", "note"),
            Field("home_element_name", "home_element_name"),
        ),
        partition_column="created_at",
    ),
    "task_tags": Child("task_tags", "task_pk", ("task_pk", "tag_pk"), (Field("id", "tag_id", "id"),), source="task_tags"),
    "supplies": Child(
        "task_supplies", "task_pk", ("task_pk", "supply_usage_id"),
        (
            Field("id", "supply_usage_id"),
            Field("supply_id", "supply_id"),
            Field("name", "name"),
            Field("description", "description"),
            Field("size", "size"),
            Field("quantity", "quantity", "num"),
            Field("unit_cost", "unit_cost", "num"),
            Field("total_price", "total_price", "num"),
            Field("bill_to", "bill_to"),
            Field("billable", "billable", "bool"),
            Field("markup_pricing_type", "markup_pricing_type"),
            Field("markup_rate", "markup_rate", "num"),
        ),
        source="supplies",
    ),
    "costs": Child(
        "task_costs", "task_pk", ("task_pk", "cost_id"),
        (
            Field("id", "cost_id"),
            Field("cost", "cost", "num"),
            Field("description", "description"),
            Field("bill_to", "bill_to"),
            Field("created_at", "created_at"),
            Field("updated_at", "updated_at"),
        ),
        nested={"type_cost": (
            Field("id", "type_cost_id"),
            Field("code", "type_cost_code"),
            Field("name", "type_cost_name"),
        )},
        source="costs",
    ),
}

ENTITIES = {
    e.name: e
    for e in (
        Entity(
            "properties", ("property_id", "region_code"),
            (
                Field("id", "property_id"),
                Field("company_id", "company_id", "any"),
                Field("name", "property_name"),
                Field("status", "property_status"),
                Field("reference_company_id", "reference_company_id"),
                Field("reference_external_property_id", "reference_external_property_id"),
                Field("reference_property_id", "reference_property_id"),
                Field("address1", "property_address1"),
                Field("address2", "property_address2"),
                Field("city", "property_city"),
                Field("state", "property_state"),
                Field("zipcode", "property_zipcode"),
                Field("country", "property_country"),
                Field("building", "property_building"),
                Field("latitude", "latitude_numeric", "any"),
                Field("longitude", "longitude_numeric", "any"),
                Field("display", "property_display", "bool"),
                Field("wifi_name", "wifi_name"),
                Field("wifi_password", "wifi_password"),
                Field("bedrooms", "bedrooms", "int"),
                Field("bathrooms", "bathrooms", "int"),
                Field("living_area", "living_area", "int"),
                Field("year_built", "year_built", "int"),
            ),
            nested={
                "notes": (
                    Field("about", "property_notes_general"),
                    Field("access", "property_notes_access"),
                    Field("guest_access", "property_notes_guest_access"),
                    Field("direction", "property_notes_direction"),
                    Field("trash_info", "property_notes_trash_info"),
                    Field("wifi", "property_notes_wifi"),
                )
            },
            children={"photos": PROPERTY_PHOTOS, "contacts": PROPERTY_CONTACTS},
            required_status="active",
            no_update=("property_status",),
        ),
        Entity(
            "reservations", ("reservation_id", "region_code"),
            (
                Field("id", "reservation_id"),
                Field("property_id", "property_id"),
                Field("status", "reservation_status"),
                Field("access_code", "access_code"),
                Field("checkin_date", "checkin_date"),
                Field("checkin_time", "checkin_time"),
                Field("checkin_early", "checkin_early", "bool"),
                Field("checkout_date", "checkout_date"),
                Field("checkout_time", "checkout_time"),
                Field("checkout_late", "checkout_late", "bool"),
                Field("note", "reservation_note"),
                Field("guide_url", "guide_url"),
                Field("reference_reservation_id", "reference_reservation_id"),
                Field("reference_property_id", "reference_property_id"),
                Field("reference_external_property_id", "reference_external_property_id"),
                Field("adults", "adults", "int"),
                Field("children", "children", "int"),
                Field("pets", "pets", "int"),
                Field("source", "source"),
            ),
            children={"guests": RESERVATION_GUESTS},
        ),
        Entity(
            "tasks", ("task_id", "region_code"),
            (
                Field("id", "task_id"),
                Field("home_id", "home_id"),
                Field("name", "task_name"),
                Field("description", "task_description"),
                Field("status", "task_status"),
                Field("paused", "task_paused", "bool"),
                Field("bill_to", "bill_to"),
                Field("rate_type", "rate_type"),
                Field("rate_paid", "rate_paid", "any"),
                Field("created_at", "created_at"),
                Field("finished_at", "finished_at"),
                Field("started_at", "started_at"),
                Field("template_id", "template_task_id"),
                Field("type_department", "type_department"),
                Field("type_priority", "type_priority"),
                Field("scheduled_date", "scheduled_date"),
                Field("scheduled_time", "scheduled_time"),
                Field("checkin_date", "checkin_date"),
                Field("checkout_date", "checkout_date"),
                Field("report_url", "report_url"),
                Field("reference_property_id", "reference_property_id"),
                Field("total_cost", "total_cost", "num"),
                Field("total_time", "total_time", "int"),
                Field("estimated_time", "estimated_time", "int"),
                Field("estimated_rate", "estimated_rate", "num"),
                Field("billable", "billable", "bool"),
                Field("itemized_cost", "itemized_cost", "bool"),
                Field("task_series_id", "task_series_id"),
                Field("parent_task_id", "parent_task_id"),
            ),
            nested={
                "created_by": (Field("id", "created_by_id"), Field("name", "created_by_name")),
                "finished_by": (Field("id", "finished_by_id"), Field("name", "finished_by_name")),
                "type_task_status": (
                    Field("code", "task_status_code"),
                    Field("name", "task_status_name"),
                    Field("stage", "task_status_stage"),
                ),
                "subdepartment": (Field("id", "subdepartment_id"), Field("name", "subdepartment_name")),
                "template": (Field("name", "template_name"),),
                "requested_by": (Field("id", "requested_by_id"), Field("name", "requested_by_name")),
                "summary": (Field("note", "summary_note"),),
                "linked_reservation": (
                    Field("id", "linked_reservation_id"),
                    Field("external_reservation_id", "linked_reservation_external_id"),
                ),
            },
            children=TASK_CHILDREN,
            partition_column="created_at",
        ),
        Entity(
            "people", ("person_id", "region_code"),
            (
                Field("id", "person_id"),
                Field("name", "person_name"),
                Field("active", "active", "bool"),
                Field("accept_decline_tasks", "accept_decline_tasks", "bool"),
            ),
            nested={
                "availability": (
                    Field("monday", "availability_monday"),
                    Field("tuesday", "availability_tuesday"),
                    Field("wednesday", "availability_wednesday"),
                    Field("thursday", "availability_thursday"),
                    Field("friday", "availability_friday"),
                    Field("saturday", "availability_saturday"),
                    Field("sunday", "availability_sunday"),
                )
            },
        ),
        Entity(
            "supplies", ("supply_id", "region_code"),
            (
                Field("id", "supply_id"),
                Field("company_id", "company_id", "any"),
                Field("name", "supply_name"),
                Field("description", "description"),
                Field("size", "size"),
                Field("internal_id", "internal_id"),
                Field("unit_cost", "unit_cost", "num"),
                Field("stock_count", "stock_count", "int"),
                Field("low_stock_alert", "low_stock_alert", "bool"),
                Field("low_stock_count", "low_stock_count", "int"),
                Field("supply_category_id", "supply_category_id"),
            ),
            nested={"type_stock_status": (
                Field("code", "stock_status_code"),
                Field("name", "stock_status_name"),
            )},
        ),
        Entity("tags", ("tag_id", "region_code"), (
            Field("id", "tag_id"),
            Field("name", "tag_name"),
            Field("description", "tag_description"),
        )),
        Entity(
            "subdepartments", ("subdepartment_id", "region_code"),
            (
                Field("id", "subdepartment_id"),
                Field("name", "subdepartment_name"),
                Field("reference_company_id", "reference_company_id"),
            ),
        ),
        Entity("templates", ("template_id", "region_code"), (
            Field("id", "template_id"),
            Field("template_name", "template_name"),
            Field("department_code", "department_code"),
        )),
        Entity("property_tags", ("property_tag_id", "region_code"), (
            Field("id", "property_tag_id"),
            Field("name", "tag_name"),
            Field("company_id", "company_id", "any"),
        )),
        Entity(
            "reservation_tags", ("reservation_tag_id", "region_code"),
            (
                Field("id", "reservation_tag_id"),
                Field("name", "tag_name"),
                Field("company_id", "company_id", "any"),
            ),
        ),
    )
}
