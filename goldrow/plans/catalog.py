"""Entity families, rule catalogue and column mappings.

Everything here is contract: names and order the surrounding systems rely on.
"""

from __future__ import annotations

from goldrow.plans.specs import Col, DQRule, Json, Null, TypedField

# Entity tables per family, with the table each is checked against.
REFERENCE_TABLE = {
    "hcp_name": "hcp_address",
    "hco_name": "hco_address",
    "hcp_address": "hcp_name",
    "hco_address": "hco_name",
    "hcp_email": "hcp_name",
    "hcp_alternate_name": "hcp_name",
    "hcp_identification": "hcp_name",
    "hcp_specialty": "hcp_name",
    "hcp_phone": "hcp_name",
    "hcp_education": "hcp_name",
    "hcp_origin_university": "hcp_name",
    "hcp_tax": "hcp_name",
    "hcp_tendencies": "hcp_name",
    "hcp_language": "hcp_name",
    "hco_email": "hco_name",
    "hco_alternate_name": "hco_name",
    "hco_identification": "hco_name",
    "hco_specialty": "hco_name",
    "hco_phone": "hco_name",
    "hco_tax": "hco_name",
    "hcp_hco_affiliation": "hcp_name",
    "hco_hco_hierarchy": "hco_name",
}

# Columns a key may have in a parent table, in order of preference.
PARENT_KEY_CANDIDATES = (
    "Source_ID",
    "Source_FK",
    "Third_Party_ID",
    "individualEid",
    "individualId",
    "iqvia_id",
)

# Columns stamped on rows by the quality gate.
DQ_COLUMNS = ("DQ_RULE", "DQ_STATUS", "DQ_DESCRIPTION", "DQ_APPL_COLUMN", "DQ_PROCESSED_AT")

# Stages in order, each gated on all earlier ones.
STAGES = ("raw_ingestion", "stdz", "canonical", "dq", "ingress", "egress")

# Texts of the rule catalogue.
_NULL = "Reject records if the value of the column is Null"
_COMPLETE = "Reject records in name table if no complete address is present"
_ADDRESS = "Reject records if no complete address is present or source_fk is not present in name table"
_AFFILIATION = "Reject records in name table if source id is not present"
_HIERARCHY = "Reject records if source id is not present in name table"

_NO_EMAIL = (
    "Reject records if the value of the source_fk is not present in email table"
)
_NO_ALTERNATE_NAME = (
    "Reject records if the value of the source_fk is not present in alternate name table"
)
_NO_IDENTIFICATION = (
    "Reject records if the value of the source_fk is not present in identification table"
)
_NO_SPECIALTY = (
    "Reject records if the value of the source_fk is not present in specialty table"
)
_NO_PHONE = (
    "Reject records if the value of the source_fk is not present in phone table"
)
_NO_EDUCATION = (
    "Reject records if the value of the source_fk is not present in education table"
)
_NO_ORIGIN_UNIVERSITY = (
    "Reject records if the value of the source_fk is not present in origin university table"
)
_NO_TABLE = (
    "Reject records if the value of the source_fk is not present in table"
)
_NO_TENDENCIES = (
    "Reject records if the value of the source_fk is not present in tendencies table"
)
_NO_LANGUAGE = (
    "Reject records if the value of the source_fk is not present in language table"
)

# Fixed values: (table, rule, column, description) of the rule catalogue, in execution order.
DQ_RULES = tuple(
    DQRule(table, rule, description, column, table)
    for table, rule, column, description in (
        ("hco_name", "null_check", "organization_name", _NULL),
        ("hcp_name", "null_check", "first_name", _NULL),
        ("hcp_name", "name_address_completeness_check", "iqvia_id", _COMPLETE),
        ("hco_name", "name_address_completeness_check", "iqvia_id", _COMPLETE),
        ("hcp_address", "address_mdr_check", "iqvia_id", _ADDRESS),
        ("hco_address", "address_mdr_check", "iqvia_id", _ADDRESS),
        ("hcp_email", "mdr_check", "iqvia_id", _NO_EMAIL),
        ("hcp_alternate_name", "mdr_check", "iqvia_id", _NO_ALTERNATE_NAME),
        ("hcp_identification", "mdr_check", "iqvia_id", _NO_IDENTIFICATION),
        ("hcp_specialty", "mdr_check", "iqvia_id", _NO_SPECIALTY),
        ("hcp_phone", "mdr_check", "iqvia_id", _NO_PHONE),
        ("hcp_education", "mdr_check", "iqvia_id", _NO_EDUCATION),
        ("hcp_origin_university", "mdr_check", "iqvia_id", _NO_ORIGIN_UNIVERSITY),
        ("hcp_tax", "mdr_check", "iqvia_id", _NO_TABLE),
        ("hco_tax", "mdr_check", "iqvia_id", _NO_TABLE),
        ("hco_email", "mdr_check", "iqvia_id", _NO_EMAIL),
        ("hco_alternate_name", "mdr_check", "iqvia_id", _NO_ALTERNATE_NAME),
        ("hco_identification", "mdr_check", "iqvia_id", _NO_IDENTIFICATION),
        ("hco_specialty", "mdr_check", "iqvia_id", _NO_SPECIALTY),
        ("hco_phone", "mdr_check", "iqvia_id", _NO_PHONE),
        ("hcp_hco_affiliation", "affiliation_mdr_check", "iqvia_id", _AFFILIATION),
        ("hco_hco_hierarchy", "hierarchy_mdr_check", "iqvia_id", _HIERARCHY),
        ("hcp_tendencies", "mdr_check", "iqvia_id", _NO_TENDENCIES),
        ("hcp_language", "mdr_check", "iqvia_id", _NO_LANGUAGE),
    )
)

# Typed organization ingress, (source column, target column, target type)
# per (source table, target table).
_TYPED = {
    ("hco_name", "hco_name"): (
        ("Source_Name", "sourceSystem", "string"),
        ("Population_Name", "populationName", "string"),
        ("HCO_Name", "HCO_name", "string"),
        ("HCO_Subtype", "HCO_companyType", "string"),
        ("Country", "HCO_countryOfIncorporation", "string"),
        ("Bed_Count", "HCO_X_informatica_bedCount", "integer"),
        ("Resident_Count", "HCO_X_informatica_residentCount", "integer"),
        ("Website", "HCO_X_informatica_website", "string"),
        ("HCO_Type", "HCO_X_informatica_type", "string"),
        ("Status", "HCO_X_hco_status", "string"),
        ("Transparency_Reporting_Name", "HCO_X_transparency_reporting_name", "string"),
        ("Official_Name", "HCO_X_official_name", "string"),
        ("Parent_Organization_Name", "HCO_X_parent_organization_name", "string"),
        ("Teaching_Hospital_Flag", "HCO_X_TeachingHospitalFlag", "integer"),
        ("Profit_Flag", "HCO_X_ProfitFlag", "integer"),
        ("Accept_Medicare", "HCO_X_AcceptMedicare", "integer"),
        ("E_Medical_Record", "HCO_X_EMedicalRecord", "string"),
        ("Pay_Perform", "HCO_X_PayPerform", "string"),
        ("E_Prescribe", "HCO_X_EPrescribe", "string"),
        ("Formulary", "HCO_X_Formulary", "string"),
        ("Activation_Date", "HCO_X_ActivationDate", "date/time"),
        ("Accept_Medicaid", "HCO_X_AcceptMedicaid", "integer"),
        ("Ownership_Status", "HCO_X_ownership_status", "string"),
        ("Source_Created_Date", "HCO_X_source_createdate", "date/time"),
        ("Source_Updated_Date", "HCO_X_source_updatedate", "date/time"),
        ("Third_Party_ID", "HCO_X_third_party_id", "string"),
    ),
    ("hco_identification", "hco_alternate_identifier"): (
        ("Identifier_Value", "altValue", "string"),
        ("Status", "IdentifierStatus", "string"),
        ("Identifier_Issuer", "X_informatica_identifierIssuer", "string"),
        ("Issuing_Country", "X_informatica_issuingCountry", "string"),
        ("Issuing_State", "X_informatica_issuingState", "string"),
        ("Activation_Date", "X_activation_date", "date/time"),
        ("Expiration_Date", "X_expiration_date", "date/time"),
        ("Source_Name", "sourceSystem", "string"),
        ("Source_FK", "AlternateIdentifier_parentId", "string"),
    ),
    ("hco_phone", "hco_phone"): (
        ("Phone_PK", "sourcePKey", "string"),
        ("Primary_Phone", "X_primary_phone", "integer"),
        ("Phone_Usage_Type", "X_phone_usage_type", "string"),
        ("Phone_Type", "X_phone_type", "string"),
        ("Phone_Number", "X_phone_number", "string"),
        ("Phone_Number_Extension", "X_phone_number_extension", "string"),
        ("ISO", "X_iso", "string"),
        ("Status", "X_phone_status", "string"),
        ("Effective_Start_Date", "X_effective_start_date", "date/time"),
        ("Effective_End_Date", "X_effective_end_date", "date/time"),
        ("Source_Name", "sourceSystem", "string"),
        ("Source_FK", "X_phone_parentId", "string"),
    ),
    ("hco_specialty", "hco_specialty"): (
        ("Specialty_PK", "sourcePKey", "string"),
        ("Specialty_Rank", "X_informatica_rank", "string"),
        ("Specialty", "X_informatica_Specialty", "string"),
        ("Specialty_Type", "X_specialty_type", "string"),
        ("Status", "X_specialty_status", "string"),
        ("Specialty_Source", "X_specialty_source", "string"),
        ("Global_Specialty", "X_global_specialty", "string"),
        ("Group_Specialty", "X_group_specialty", "string"),
        ("Source_Name", "sourceSystem", "string"),
    ),
}

TYPED_INGRESS = tuple(
    TypedField(source_table, source, target_table, target, kind)
    for (source_table, target_table), fields in _TYPED.items()
    for source, target, kind in fields
)

# Ingress mapping per entity table. "json:" keys are paths into the
# document column, all others are plain columns.
INGRESS_FIELDS = {
    "hcp_name": {
        "iqvia_id": "individualEid",
        "first_name": "firstName",
        "middle_name": "middleName",
        "last_name": "lastName",
        "country_code": "countryCode",
        "full_name": "fullName",
        "gender": "gender",
        "json:title": "prefixName",
        "json:transparencyReportingName": "X_transparency_reporting_name",
        "json:status": "X_hcp_status",
        "json:type": "X_informatica_type",
        "json:iqviaTitle": "X_iqvia_title",
    },
    "hcp_specialty": {
        "iqvia_id": "individualEid",
        "json:specialty": "X_informatica_Specialty",
        "json:specialtyType": "X_specialty_type",
        "json:specialtyRank": "X_informatica_rank",
        "json:specialtyStatus": "X_specialty_status",
        "json:qualification": "Qualification",
    },
    "hcp_alternate_name": {
        "iqvia_id": "individualEid",
        "json:alternateName": "AlternateName",
        "json:alternateNameType": "AlternateNameType",
    },
    "hcp_address": {
        "iqvia_id": "individualEid",
        "json:addresses[0].addressLine1": "X_hcp_address",
        "json:addresses[0].city": "X_hcp_city",
        "json:addresses[0].postalCode": "X_hcp_postal_code",
        "json:addresses[0].country": "X_hcp_country",
    },
    "hcp_phone": {
        "iqvia_id": "individualEid",
        "json:phones[0].phoneNumber": "Phone",
        "json:phones[0].phoneType": "X_phone_type",
    },
    "hcp_email": {
        "iqvia_id": "individualEid",
        "json:emails[0].email": "ElectronicAddress",
        "json:emails[0].emailType": "X_email_type",
    },
    "hcp_identification": {
        "iqvia_id": "individualEid",
        "json:licenseNumber": "X_informatica_License",
        "json:deaNumber": "X_informatica_dea",
        "json:alternateIdentifier": "AlternateIdentifier",
    },
    "hcp_education": {
        "iqvia_id": "individualEid",
        "json:qualification": "Qualification",
        "json:institutionName": "X_institution_name",
        "json:graduationYear": "X_graduation_year",
    },
    "hcp_tax": {
        "iqvia_id": "individualEid",
        "json:deaNumber": "X_informatica_dea",
        "json:deaType": "X_dea_type",
    },
    "hcp_language": {
        "iqvia_id": "individualEid",
        "json:language": "X_language",
        "json:languageCode": "X_language_code",
    },
    "hcp_tendencies": {
        "iqvia_id": "individualEid",
        "json:tendency": "X_tendency",
        "json:tendencyValue": "X_tendency_value",
    },
    "hcp_origin_university": {
        "iqvia_id": "individualEid",
        "json:universityName": "X_university_name",
        "json:graduationYear": "X_graduation_year",
    },
    "hcp_hco_affiliation": {
        "iqvia_id": "individualEid",
        "json:organizationId": "X_organization_id",
        "json:affiliationType": "X_affiliation_type",
        "json:startDate": "X_affiliation_start",
        "json:endDate": "X_affiliation_end",
    },
    "hco_name": {
        "iqvia_id": "organizationEid",
        "json:organizationName": "organizationName",
        "json:organizationType": "organizationType",
        "country_code": "countryCode",
    },
    "hco_address": {
        "iqvia_id": "organizationEid",
        "json:addresses[0].addressLine1": "Address_Line_1",
        "json:addresses[0].city": "City",
        "json:addresses[0].postalCode": "Postal_Code",
        "json:addresses[0].country": "Country",
    },
    "hco_phone": {
        "iqvia_id": "organizationEid",
        "json:phones[0].phoneNumber": "Phone",
    },
    "hco_email": {
        "iqvia_id": "organizationEid",
        "json:emails[0].email": "Email",
    },
    "hco_alternate_name": {
        "iqvia_id": "organizationEid",
        "json:alternateName": "Alternate_Name",
        "json:alternateNameType": "Alternate_Name_Type",
    },
    "hco_identification": {
        "iqvia_id": "organizationEid",
        "json:alternateIdentifier": "Alternate_Identifier",
        "json:identifierType": "X_identifier_type",
    },
    "hco_specialty": {
        "iqvia_id": "organizationEid",
        "json:specialty": "Specialty",
        "json:specialtyType": "Specialty_Type",
        "json:specialtyRank": "Specialty_Rank",
        "json:status": "Status",
    },
    "hco_hco_hierarchy": {
        "iqvia_id": "organizationEid",
        "json:parentOrganizationId": "X_parent_org_id",
        "json:parentOrganizationName": "X_parent_org_name",
        "json:relationshipType": "X_relationship_type",
    },
    "hco_tax": {
        "iqvia_id": "organizationEid",
        "json:taxId": "X_tax_id",
        "json:taxType": "X_tax_type",
    },
}

#: The feed's own spelling of the ingress paths: the paths above, replaced where the
#: document feed uses names with blanks (the same ones the staging views read).
SPACED_PATHS = {
    "hcp_name": {
        "title": "['Prefix Name'].Name",
        "transparencyReportingName": "['Transparency Reporting Name']",
        "status": "['HCP Status'].Name",
        "type": "Type.Name",
        "iqviaTitle": "Title",
    },
    "hcp_specialty": {
        "specialty": "Specialty[0]['Specialty Class']",
        "specialtyType": "Specialty[0]['Specialty Type']",
        "specialtyRank": "Specialty[0]['Specialty Rank'].Name",
        "specialtyStatus": "Specialty[0]['Specialty Status'].Name",
    },
    "hcp_alternate_name": {
        "alternateName": "['Alternate Name'][0]['Alternate Name']",
        "alternateNameType": "['Alternate Name'][0]['Alternate Name Type']",
    },
    "hcp_address": {
        "addresses[0].addressLine1": "['HCP Address'][0]['Address Line 1']",
        "addresses[0].city": "['HCP Address'][0].City",
        "addresses[0].postalCode": "['HCP Address'][0]['Postal Code']",
        "addresses[0].country": "['HCP Address'][0].Country.Name",
    },
    "hcp_phone": {
        "phones[0].phoneNumber": "Phone[0]['Phone Number']",
        "phones[0].phoneType": "Phone[0]['Phone Type'].Name",
    },
    "hcp_email": {"emails[0].email": "Email[0]"},
    "hcp_identification": {
        "alternateIdentifier": "['Alternate Identifier'][0]['Identifier Value']",
        "licenseNumber": "License[0]['License Number']",
        "deaNumber": "DEA[0]['DEA Number']",
    },
    "hcp_tax": {"deaNumber": "DEA[0]['DEA Number']"},
    "hco_name": {
        "organizationName": "['Organization Name']",
        "organizationType": "['Organization Type']",
    },
    "hco_address": {
        "addresses[0].addressLine1": "Addresses[0].addressLine1",
        "addresses[0].city": "Addresses[0].city",
        "addresses[0].postalCode": "Addresses[0].postalCode",
        "addresses[0].country": "Addresses[0].country",
    },
    "hco_phone": {"phones[0].phoneNumber": "Phones[0].phoneNumber"},
    "hco_identification": {"alternateIdentifier": "Identifiers[0].identifierValue"},
    "hco_tax": {"taxId": "['Tax Id']"},
}

# The person name projection, as (output, input, type); the hashed key and the
# full name are functions of their inputs.
PERSON_NAME = (
    ("Name_PK", ("individualEid",), "hashed_key"),
    ("firstName", ("firstName",), "string"),
    ("middleName", ("middleName",), "string"),
    ("lastName", ("lastName",), "string"),
    ("Full_Name", ("firstName", "middleName", "lastName"), "full_name"),
    ("genderCode", ("genderCode",), "string"),
    ("Country", ("countryCode",), "string"),
    ("individualEid", ("individualEid",), "string"),
    ("Source_Name", ("Source_Name",), "string"),
    ("LOAD_DATE", ("LOAD_DATE",), "timestamp"),
    ("BATCH_ID", ("BATCH_ID",), "bigint"),
)

# Ingress table -> published target(s).
INGRESS_TARGETS = {
    "hcp_name": ("hcp",),
    "hcp_specialty": ("hcp_specialty",),
    "hcp_alternate_name": ("hcp_alternate_name",),
    "hcp_identification": ("hcp_identification",),
    "hcp_education": ("hcp_education",),
    "hcp_address": ("hcp_address",),
    "hcp_phone": ("hcp_phone",),
    "hcp_email": ("hcp_email",),
    "hcp_tendencies": ("hcp_tendencies",),
    "hcp_origin_university": ("hcp_origin_university",),
    "hcp_tax": ("hcp_tax",),
    "hcp_language": ("hcp_language",),
    "hcp_hco_affiliation": ("hcp_hco_affiliation",),
    "hco_name": ("hco", "hco_name"),
    "hco_identification": ("hco_alternate_identifier",),
    "hco_phone": ("hco_phone",),
    "hco_specialty": ("hco_specialty",),
    "hco_alternate_name": ("hco_alternate_name",),
    "hco_address": ("hco_address",),
    "hco_email": ("hco_email",),
    "hco_hco_hierarchy": ("hco_hco_hierarchy",),
    "hco_tax": ("hco_tax",),
}

# Tables copied to the warehouse, source -> target name.
PUBLISHED_STAGING = {t: t.upper() for t in REFERENCE_TABLE} | {"hco_hco_hierarchy": "HCO_HIERARCHY"}
PUBLISHED_MASTER = {
    t: t.upper()
    for t in (
        "hcp",
        "hcp_specialty",
        "hcp_alternate_name",
        "hcp_education",
        "hcp_identification",
        "hco",
        "hco_name",
        "hco_alternate_identifier",
        "hco_phone",
        "hco_specialty",
    )
}

# Staging views. Every view starts with the business key.
STAGING_VIEWS = {
    "hcp_name": {
        "X_transparency_reporting_name": Json(("Transparency Reporting Name",)),
        "firstName": Json(("First Name",)),
        "middleName": Json(("Middle Name",)),
        "lastName": Json(("Last Name",)),
        "fullName": Json(("Full Name",)),
        "gender": Json(("Gender", "Name")),
        "X_informatica_type": Json(("Type", "Name")),
        "X_hcp_status": Json(("HCP Status", "Name")),
        "X_iqvia_title": Json(("Title",)),
        "prefixName": Json(("Prefix Name", "Name")),
    },
    "hcp_address": {"X_hcp_address": Json(("HCP Address", 0, "Address Line 1"))},
    "hcp_alternate_name": {"AlternateName": Json(("Alternate Name", 0, "Alternate Name"))},
    "hcp_education": {"Qualification": Null()},
    "hcp_email": {"ElectronicAddress": Json(("Email", 0))},
    "hcp_hco_affiliation": {"HCO_EID": Null(), "Relationship_Type": Null()},
    "hcp_identification": {
        "AlternateIdentifier": Json(("Alternate Identifier", 0, "Identifier Value"))
    },
    "hcp_language": {"Language": Null()},
    "hcp_origin_university": {"University_Name": Null(), "University_Code": Null()},
    "hcp_phone": {"Phone": Json(("Phone", 0, "Phone Number"))},
    "hcp_specialty": {"X_informatica_Specialty": Json(("Specialty", 0, "Specialty Class"))},
    "hcp_tax": {"X_informatica_dea": Json(("DEA", 0, "DEA Number"))},
    "hcp_tendencies": {"Code": Null(), "Rank": Null()},
    "hco_address": {
        "Address_Line_1": Json(("Addresses", 0, "addressLine1")),
        "City": Json(("Addresses", 0, "city")),
        "Postal_Code": Json(("Addresses", 0, "postalCode")),
        "Country": Json(("Addresses", 0, "country")),
    },
    "hco_alternate_name": {"Alternate_Name": Null(), "Alternate_Name_Type": Null()},
    "hco_email": {"Email": Null()},
    "hco_hierarchy": {"Parent_Organization_EID": Null(), "Relationship_Type": Null()},
    "hco_identification": {
        "Identifier_Value": Json(("Identifiers", 0, "identifierValue")),
        "Status": Null(),
        "Identifier_Issuer": Null(),
        "Issuing_Country": Null(),
        "Issuing_State": Null(),
        "Activation_Date": Null(),
        "Expiration_Date": Null(),
        "Source_Name": Col("source_name"),
    },
    "hco_name": {
        "Source_Name": Col("source_name"),
        "Population_Name": Null(),
        "HCO_Name": Col("organization_name"),
        "HCO_Subtype": Col("organization_type"),
        "Country": Col("country_code"),
        "Bed_Count": Null(),
        "Resident_Count": Null(),
        "Website": Null(),
        "HCO_Type": Null(),
        "Status": Null(),
        "Transparency_Reporting_Name": Null(),
        "Official_Name": Null(),
        "Parent_Organization_Name": Null(),
        "Teaching_Hospital_Flag": Null(),
        "Profit_Flag": Null(),
        "Accept_Medicare": Null(),
        "E_Medical_Record": Null(),
        "Pay_Perform": Null(),
        "E_Prescribe": Null(),
        "Formulary": Null(),
        "Activation_Date": Null(),
        "Accept_Medicaid": Null(),
        "Ownership_Status": Null(),
        "Source_Created_Date": Null(),
        "Source_Updated_Date": Null(),
        "Third_Party_ID": Null(),
    },
    "hco_phone": {
        "Phone_PK": Null(),
        "Primary_Phone": Json(("Phones", 0, "phoneNumber")),
        "Phone_Usage_Type": Null(),
        "Phone_Type": Json(("Phones", 0, "phoneType")),
        "Phone_Number": Json(("Phones", 0, "phoneNumber")),
        "Phone_Number_Extension": Null(),
        "ISO": Null(),
        "Status": Null(),
        "Effective_Start_Date": Null(),
        "Effective_End_Date": Null(),
        "Source_Name": Col("source_name"),
    },
    "hco_specialty": {
        "Source_Name": Col("source_name"),
        "Specialty_PK": Null(),
        "Specialty_Rank": Null(),
        "Specialty": Null(),
        "Specialty_Type": Null(),
        "Status": Null(),
        "Specialty_Source": Null(),
        "Global_Specialty": Null(),
        "Group_Specialty": Null(),
    },
    "hco_tax": {"Tax_Number": Json(("Tax Id",))},
}

# The one view that never has rows.
EMPTY_VIEWS = {"hcp_license": ("X_informatica_License",)}

# Person consolidation, (view, source column, target column).
PERSON_ANCHOR = "hcp_name"
PERSON_COLUMNS = (
    ("hcp_name", "X_transparency_reporting_name", "X_transparency_reporting_name"),
    ("hcp_name", "firstName", "firstName"),
    ("hcp_name", "middleName", "middleName"),
    ("hcp_name", "lastName", "lastName"),
    ("hcp_name", "fullName", "fullName"),
    ("hcp_name", "gender", "gender"),
    ("hcp_name", "X_informatica_type", "X_informatica_type"),
    ("hcp_name", "X_hcp_status", "X_hcp_status"),
    ("hcp_name", "X_iqvia_title", "X_iqvia_title"),
    ("hcp_name", "prefixName", "prefixName"),
    ("hcp_alternate_name", "AlternateName", "AlternateName"),
    ("hcp_address", "X_hcp_address", "X_hcp_address"),
    ("hcp_phone", "Phone", "Phone"),
    ("hcp_specialty", "X_informatica_Specialty", "X_informatica_Specialty"),
    ("hcp_education", "Qualification", "Qualification"),
    ("hcp_license", "X_informatica_License", "X_informatica_License"),
    ("hcp_tax", "X_informatica_dea", "X_informatica_dea"),
    ("hcp_identification", "AlternateIdentifier", "AlternateIdentifier"),
    ("hcp_email", "ElectronicAddress", "ElectronicAddress"),
    ("hcp_hco_affiliation", "HCO_EID", "X_hco_affiliation_eid"),
    ("hcp_hco_affiliation", "Relationship_Type", "X_hco_affiliation_type"),
    ("hcp_language", "Language", "X_informatica_language"),
    ("hcp_origin_university", "University_Name", "X_origin_university_name"),
    ("hcp_origin_university", "University_Code", "X_origin_university_code"),
    ("hcp_tendencies", "Code", "X_informatica_tendency_code"),
    ("hcp_tendencies", "Rank", "X_informatica_tendency_rank"),
)

# Organization consolidation, anchored on the address view.
ORGANIZATION_ANCHOR = "hco_address"
ORGANIZATION_COLUMNS = (
    ("hco_name", "HCO_Name", "HCO_name"),
    ("hco_name", "HCO_Subtype", "HCO_companyType"),
    ("hco_name", "HCO_Type", "HCO_X_informatica_type"),
    ("hco_name", "Status", "HCO_X_hco_status"),
    ("hco_name", "Transparency_Reporting_Name", "HCO_X_transparency_reporting_name"),
    ("hco_name", "Official_Name", "HCO_X_official_name"),
    ("hco_name", "Parent_Organization_Name", "HCO_X_parent_organization_name"),
    ("hco_name", "Teaching_Hospital_Flag", "HCO_X_TeachingHospitalFlag"),
    ("hco_name", "Profit_Flag", "HCO_X_ProfitFlag"),
    ("hco_name", "Accept_Medicare", "HCO_X_AcceptMedicare"),
    ("hco_name", "E_Medical_Record", "HCO_X_EMedicalRecord"),
    ("hco_name", "Pay_Perform", "HCO_X_PayPerform"),
    ("hco_name", "E_Prescribe", "HCO_X_EPrescribe"),
    ("hco_name", "Formulary", "HCO_X_Formulary"),
    ("hco_name", "Activation_Date", "HCO_X_ActivationDate"),
    ("hco_name", "Accept_Medicaid", "HCO_X_AcceptMedicaid"),
    ("hco_name", "Ownership_Status", "HCO_X_ownership_status"),
    ("hco_name", "Source_Created_Date", "HCO_X_source_createdate"),
    ("hco_name", "Source_Updated_Date", "HCO_X_source_updatedate"),
    ("hco_name", "Third_Party_ID", "HCO_X_third_party_id"),
    ("hco_name", "Source_Name", "sourceSystem"),
    ("hco_name", "Population_Name", "populationName"),
    ("hco_name", "Country", "HCO_countryOfIncorporation"),
    ("hco_name", "Bed_Count", "HCO_X_informatica_bedCount"),
    ("hco_name", "Resident_Count", "HCO_X_informatica_residentCount"),
    ("hco_name", "Website", "HCO_X_informatica_website"),
    ("hco_address", "Address_Line_1", "X_hco_address"),
    ("hco_address", "City", "X_hco_city"),
    ("hco_address", "Postal_Code", "X_hco_postal_code"),
    ("hco_address", "Country", "X_hco_country"),
    ("hco_alternate_name", "Alternate_Name", "AlternateName"),
    ("hco_alternate_name", "Alternate_Name_Type", "AlternateNameType"),
    ("hco_email", "Email", "ElectronicAddress"),
    ("hco_hierarchy", "Parent_Organization_EID", "X_parent_organization_eid"),
    ("hco_hierarchy", "Relationship_Type", "X_hierarchy_relationship_type"),
    ("hco_tax", "Tax_Number", "X_informatica_tax_number"),
)

# Renames of the person master and its children, source -> target.
PERSON_MASTER = {
    "SOURCE_FK": "SOURCE_FK",
    "X_transparency_reporting_name": "Transparency_Reporting_Name",
    "firstName": "First_Name",
    "middleName": "Middle_Name",
    "lastName": "Last_Name",
    "fullName": "Full_Name",
    "gender": "Gender",
    "X_informatica_type": "HCP_Type",
    "X_hcp_status": "Status",
    "X_iqvia_title": "Title",
    "prefixName": "Prefix_Name",
    "X_hcp_address": "Address",
    "Phone": "Phone",
    "Qualification": "Qualification",
    "X_informatica_dea": "DEA_Number",
    "AlternateIdentifier": "Alternate_Identifier",
    "ElectronicAddress": "Email",
    "X_hco_affiliation_eid": "HCO_Affiliation_EID",
    "X_hco_affiliation_type": "HCO_Affiliation_Type",
    "X_informatica_language": "Language",
    "X_origin_university_name": "Origin_University_Name",
    "X_origin_university_code": "Origin_University_Code",
    "X_informatica_tendency_code": "Tendency_Code",
    "X_informatica_tendency_rank": "Tendency_Rank",
}
PERSON_CHILD_MASTERS = {
    "hcp_alternate_name": {
        "SOURCE_FK": "SOURCE_FK",
        "alternateNameType": "Name_Type",
        "AlternateName": "Alternate_Name",
        "X_alternate_name_status": "Alternate_Name_Status",
        "effectiveStartDate": "Effective_Start_Date",
        "effectiveEndDate": "Effective_End_Date",
        "O_Load_Date": "Load_Date",
    },
    "hcp_license": {
        "SOURCE_FK": "SOURCE_FK",
        "X_infa360_License_parentId": "Global_HCP_ID",
        "sourcePKey": "Source_PK",
        "X_infa360_LicenseType": "License_Type",
        "X_infa360_LicenseNumber": "License_Number",
        "X_country": "Country",
        "X_state": "State",
        "X_sample_elig": "License_Sample_Eligibility",
        "X_sampleability_overall": "Sampleability_Overall",
        "X_sampleability_lastreceived_date": "Sampleability_Last_Received_Date",
        "X_sampleability_fed_sanctions_date": "Sampleability_Fed_Sanctions_Date",
        "X_sampleability_desigstatus": "Sampleability_Designation_Status",
        "X_infa360_issueDate": "Issue_Date",
        "X_infa360_expiryDate": "Expiry_Date",
        "X_degree": "Degree",
        "X_adjLic_expdate": "Adj_License_Exp_Date",
        "X_AdjCode": "Adj_Code",
        "X_AdjCodesDescriptions": "Adj_Codes_Descriptions",
        "X_infa360_status": "License_Status",
    },
    "hcp_specialty": {
        "SOURCE_FK": "SOURCE_FK",
        "X_infa360_SpecialtyType": "Specialty",
        "X_infa360_SpecialtyClass": "Specialty_Type",
        "X_infa360_SpecialtyRank": "Specialty_Rank",
        "X_infa360_taxonomyName": "Taxonomy_Name",
        "X_infa360_group": "Group",
        "X_infa360_taxonomy_code": "Taxonomy_Code",
        "X_infa360_subClassification": "Sub_Classification",
        "X_specialty_status": "Specialty_Status",
        "O_Load_Date": "Load_Date",
    },
    "hcp_therapeutic_area": {
        "SOURCE_FK": "SOURCE_FK",
        "X_infa360_TherapeuticArea_parentId": "Global_HCP_ID",
        "X_infa360_activeIndicator": "Active_Indicator",
        "X_infa360_therapeuticArea": "Therapeutic_Area",
        "O_Load_Date": "Load_Date",
    },
}

# Organization ingress renames, (source, target); one column may feed two targets.
ORGANIZATION_INGRESS = {
    "hco_alternate_identifier": (
        ("SOURCE_FK", "SOURCE_FK"),
        ("Identifier_Value", "altValue"),
        ("Status", "IdentifierStatus"),
        ("Identifier_Issuer", "X_informatica_identifierIssuer"),
        ("Issuing_Country", "X_informatica_issuingCountry"),
        ("Issuing_State", "X_informatica_issuingState"),
        ("Activation_Date", "X_activation_date"),
        ("Expiration_Date", "X_expiration_date"),
        ("Source_Name", "sourceSystem"),
        ("SOURCE_FK", "AlternateIdentifier_parentId"),
    ),
    "hco_name": (
        ("SOURCE_FK", "SOURCE_FK"),
        ("Source_Name", "sourceSystem"),
        ("Population_Name", "populationName"),
        ("HCO_Name", "HCO_name"),
        ("HCO_Subtype", "HCO_companyType"),
        ("Country", "HCO_countryOfIncorporation"),
        ("Bed_Count", "HCO_X_informatica_bedCount"),
        ("Resident_Count", "HCO_X_informatica_residentCount"),
        ("Website", "HCO_X_informatica_website"),
        ("HCO_Type", "HCO_X_informatica_type"),
        ("Status", "HCO_X_hco_status"),
        ("Transparency_Reporting_Name", "HCO_X_transparency_reporting_name"),
        ("Official_Name", "HCO_X_official_name"),
        ("Parent_Organization_Name", "HCO_X_parent_organization_name"),
        ("Teaching_Hospital_Flag", "HCO_X_TeachingHospitalFlag"),
        ("Profit_Flag", "HCO_X_ProfitFlag"),
        ("Accept_Medicare", "HCO_X_AcceptMedicare"),
        ("E_Medical_Record", "HCO_X_EMedicalRecord"),
        ("Pay_Perform", "HCO_X_PayPerform"),
        ("E_Prescribe", "HCO_X_EPrescribe"),
        ("Formulary", "HCO_X_Formulary"),
        ("Activation_Date", "HCO_X_ActivationDate"),
        ("Accept_Medicaid", "HCO_X_AcceptMedicaid"),
        ("Ownership_Status", "HCO_X_ownership_status"),
        ("Source_Created_Date", "HCO_X_source_createdate"),
        ("Source_Updated_Date", "HCO_X_source_updatedate"),
        ("Third_Party_ID", "HCO_X_third_party_id"),
    ),
    "hco_phone": (
        ("SOURCE_FK", "SOURCE_FK"),
        ("Phone_PK", "sourcePKey"),
        ("Primary_Phone", "X_primary_phone"),
        ("Phone_Usage_Type", "X_phone_usage_type"),
        ("Phone_Type", "X_phone_type"),
        ("Phone_Number", "X_phone_number"),
        ("Phone_Number_Extension", "X_phone_number_extension"),
        ("ISO", "X_iso"),
        ("Status", "X_phone_status"),
        ("Effective_Start_Date", "X_effective_start_date"),
        ("Effective_End_Date", "X_effective_end_date"),
        ("Source_Name", "sourceSystem"),
        ("SOURCE_FK", "X_phone_parentId"),
    ),
    "hco_specialty": (
        ("SOURCE_FK", "SOURCE_FK"),
        ("Specialty_PK", "sourcePKey"),
        ("Specialty_Rank", "X_informatica_rank"),
        ("Specialty", "X_informatica_Specialty"),
        ("Specialty_Type", "X_specialty_type"),
        ("Status", "X_specialty_status"),
        ("Specialty_Source", "X_specialty_source"),
        ("Global_Specialty", "X_global_specialty"),
        ("Group_Specialty", "X_group_specialty"),
        ("Source_Name", "sourceSystem"),
    ),
}

#: Organization masters pass their ingress columns through; these drop the source system.
MASTERS_WITHOUT_SOURCE = ("hco_alternate_identifier", "hco_phone", "hco_specialty")

#: Ingress target -> staging view it reads.
ORGANIZATION_INGRESS_VIEW = {
    "hco_alternate_identifier": "hco_identification",
    "hco_name": "hco_name",
    "hco_phone": "hco_phone",
    "hco_specialty": "hco_specialty",
}


def rules_for(table: str) -> tuple[DQRule, ...]:
    """Catalogue rules of a table; qualifiers and a ``_canonical`` suffix are ignored."""
    bare = table.rsplit(".", 1)[-1].lower().removesuffix("_canonical")
    return tuple(r for r in DQ_RULES if r.table == bare)
