"""Schemas of the landed entities.

A field is ``name type [source path]``; ``json`` marks a nested leaf kept as JSON
text.  Names are those of the landed records; columns get snake case.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

TYPES = {
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampNTZType(),
    "json": T.StringType(),
}
AUDIT = (("_ingested_at", "timestamp"), ("_ingestion_source", "string"))


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    path: str

    @property
    def column(self) -> str:
        return snake(self.name)


@dataclass(frozen=True)
class Entity:
    fields: tuple[Field, ...]
    partition: str | None
    cluster: tuple[str, ...]
    key: str = "id"
    hashed: tuple[str, ...] = ()
    natural: str | None = None
    defaults: tuple[tuple[str, object], ...] = ()

    def schema(self) -> T.StructType:
        """The table schema, audit columns included."""
        columns = [T.StructField(f.column, TYPES[f.type]) for f in self.fields]
        columns += [T.StructField(n, TYPES[t]) for n, t in AUDIT]
        return T.StructType(columns)


def snake(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower()


def _entity(text: str, partition: str | None, cluster: str, **options: object) -> Entity:
    fields = []
    for part in text.split(","):
        name, kind, *path = part.split()
        fields.append(Field(name, kind, path[0] if path else name))
    return Entity(
        tuple(fields), partition, tuple(snake(c) for c in cluster.split()), **options
    )


# Fields of each entity, its partition column and its cluster columns.
ENTITIES: dict[str, Entity] = {
    "jobs": _entity(
        "id bigint, jobNumber string, projectId bigint, customerId bigint, locationId bigint,"
        "jobStatus string, completedOn timestamp, businessUnitId bigint, jobTypeId bigint,"
        "priority string, campaignId bigint, summary string, customFields json,"
        "createdOn timestamp, createdById bigint, modifiedOn timestamp, tagTypeIds json,"
        "leadCallId bigint, bookingId bigint, soldById bigint",
        "modified_on",
        "businessUnitId jobStatus",
    ),
    "invoices": _entity(
        "id bigint, syncStatus string, summary string, referenceNumber string,"
        "invoiceDate timestamp, dueDate timestamp, subTotal double, salesTax double,"
        "total double, balance double, invoiceTypeId bigint, jobId bigint job.id,"
        "projectId bigint, businessUnitId bigint businessUnit.id, locationId bigint location.id,"
        "customerId bigint customer.id, depositedOn timestamp, createdOn timestamp,"
        "modifiedOn timestamp, adjustmentToId bigint, status string, employeeId bigint,"
        "commissionEligibilityDate timestamp, items json, customFields json",
        "modified_on",
        "businessUnitId jobId status",
    ),
    "estimates": _entity(
        "id bigint, jobId bigint, projectId bigint, locationId bigint, customerId bigint,"
        "name string, jobNumber string, status string status.name, summary string,"
        "createdOn timestamp, modifiedOn timestamp, soldOn timestamp, soldById bigint soldBy,"
        "estimateNumber string, businessUnitId bigint, subtotal double, totalTax double,"
        "total double",
        "created_on",
        "businessUnitId jobId status",
    ),
    "payments": _entity(
        "id bigint, invoiceId bigint, amount double, paymentTypeId bigint typeId, status string,"
        "memo string, referenceNumber string, unappliedAmount double, businessUnitId bigint,"
        "batchId bigint, createdOn timestamp, modifiedOn timestamp",
        "created_on",
        "invoiceId paymentTypeId businessUnitId",
    ),
    "payroll": _entity(
        "id bigint, payrollId bigint, employeeId bigint, employeeType string,"
        "businessUnitName string, date timestamp, activity string, amount double,"
        "paidDurationHours double, paidTimeType string, jobId bigint, jobNumber string,"
        "invoiceId bigint, invoiceNumber string, customerId bigint, locationId bigint,"
        "sourceEntityId bigint, createdOn timestamp, modifiedOn timestamp",
        "modified_on",
        "employeeId jobId date",
        hashed=(
            "payroll_id employee_id job_id date activity amount paid_duration_hours invoice_id"
            " created_on"
        ).split(),
    ),
    "payroll_adjustments": _entity(
        "id bigint, adjustmentId bigint id, employeeId bigint, employeeType string"
        " employeeType.name, postedOn timestamp, amount double, memo string,"
        "activityCodeId bigint, invoiceId bigint, hours double, rate double,"
        "createdOn timestamp, modifiedOn timestamp, active boolean",
        "modified_on",
        "employeeId invoiceId activityCodeId",
        hashed=(
            "adjustment_id employee_id invoice_id posted_on amount activity_code_id hours"
            " created_on"
        ).split(),
        defaults=(("active", True),),
    ),
    "purchase_orders": _entity(
        "id bigint, purchaseOrderId bigint id, number string, syncStatus string, status string,"
        "vendorId bigint, vendorName string, jobId bigint, jobNumber string,"
        "businessUnitId bigint, date timestamp, requiredOn timestamp, sentOn timestamp,"
        "receivedOn timestamp, total double, tax double, shipping double, discount double,"
        "subTotal double, items json, memo string, shipToAddress json, customFields json,"
        "createdOn timestamp, modifiedOn timestamp",
        "modified_on",
        "vendorId jobId status",
        hashed="purchase_order_id number vendor_id job_id date total created_on".split(),
    ),
    "returns": _entity(
        "id bigint, returnId bigint id, number string, syncStatus string, status string,"
        "vendorId bigint, vendorName string, jobId bigint, jobNumber string,"
        "businessUnitId bigint, returnDate timestamp, total double, tax double,"
        "shipping double, subTotal double, items json, memo string, purchaseOrderId bigint,"
        "purchaseOrderNumber string, customFields json, createdOn timestamp,"
        "modifiedOn timestamp",
        "modified_on",
        "vendorId jobId returnDate",
        hashed="return_id number vendor_id job_id return_date total created_on".split(),
    ),
    "inventory_bills": _entity(
        "id bigint, inventoryBillId bigint id, purchaseOrderId bigint, syncStatus string,"
        "referenceNumber string, vendorId bigint vendor.id, vendorNumber string,"
        "vendorName string vendor.name, jobId bigint, jobNumber string,"
        "businessUnitId bigint businessUnit.id, businessUnitName string businessUnit.name,"
        "summary string, billDate timestamp, dueDate timestamp, billAmount double,"
        "taxAmount double, shippingAmount double, total double, termName string,"
        "shipToDescription string, shipTo json, batch json, taxZone json, items json,"
        "customFields json, createdBy string, createdOn timestamp, modifiedOn timestamp,"
        "active boolean",
        "modified_on",
        "vendorId jobId businessUnitId",
        hashed=(
            "inventory_bill_id purchase_order_id reference_number job_id bill_date bill_amount"
            " created_on"
        ).split(),
        defaults=(("bill_amount", 0.0), ("tax_amount", 0.0), ("shipping_amount", 0.0)),
    ),
    "appointments": _entity(
        "id bigint, jobId bigint, appointmentNumber string, scheduledStart timestamp start,"
        "scheduledEnd timestamp end, arrivalWindowStart timestamp, arrivalWindowEnd timestamp,"
        "status string, specialInstructions string, createdOn timestamp, modifiedOn timestamp,"
        "customerId bigint, customerMemoId bigint, leadCallId bigint, bookingProviderId bigint,"
        "createdById bigint, modifiedById bigint, unused boolean, isConfirmed boolean,"
        "assignedTechnicianIds json",
        "modified_on",
        "jobId status",
    ),
    "customers": _entity(
        "id bigint, active boolean, name string, type string, address json, email string,"
        "phoneNumber string, balance double, customFields json, createdOn timestamp,"
        "createdById bigint, modifiedOn timestamp, mergedToId bigint",
        "modified_on",
        "type active",
    ),
    "locations": _entity(
        "id bigint, customerId bigint, active boolean, name string, address json,"
        "taxZoneId bigint, zoneId bigint, createdOn timestamp, modifiedOn timestamp,"
        "customFields json",
        "modified_on",
        "customerId active",
    ),
    "campaigns": _entity(
        "id bigint, active boolean, name string, categoryId bigint category.id,"
        "category string category.name, createdOn timestamp, modifiedOn timestamp",
        "modified_on",
        "active categoryId",
    ),
    "job_types": _entity(
        "id bigint, name string, description string, active boolean, createdOn timestamp,"
        "modifiedOn timestamp",
        None,
        "active name",
        defaults=(("active", True),),
    ),
    "business_units": _entity(
        "id bigint, name string, active boolean, officialName string, phoneNumber string,"
        "email string, address json, timezone string timezone.name",
        None,
        "active name",
        defaults=(("active", True),),
    ),
    "technicians": _entity(
        "id bigint, name string, active boolean, businessUnitId bigint, businessUnitName string,"
        "email string, phoneNumber string, employeeId bigint, role string, team string,"
        "modifiedOn timestamp",
        None,
        "active businessUnitId",
        defaults=(("active", True),),
    ),
    "activity_codes": _entity(
        "id bigint, name string, active boolean, description string, code string,"
        "isPaid boolean, modifiedOn timestamp",
        None,
        "active name",
        defaults=(("active", True),),
    ),
}
