"""Fixed table layouts: ten vocabulary tables, eighteen source tables, twenty-seven CDM tables.

A layout is a line of column names; a trailing ``!`` marks a column that must not be NULL.
Column types follow from the names by the rules below, with the few exceptions listed per family.
"""

from __future__ import annotations

from pyspark.sql import types as T

LONG, INT, TEXT = T.LongType(), T.IntegerType(), T.StringType()
DATE, STAMP = T.DateType(), T.TimestampNTZType()
# A bare NUMERIC means DECIMAL(18,3); Spark's own bare NUMERIC is (10,0), so it is always spelled out.
NUMERIC = T.DecimalType(18, 3)
WIDE_NUMERIC = T.DecimalType(28, 3)
REAL = T.DoubleType()

# Table and column names, order and nullability of the published CDM v5.3.1 layout.
_VOCABULARY = {
    "concept": """concept_id! concept_name domain_id! vocabulary_id! concept_class_id! standard_concept
        concept_code! valid_start_date! valid_end_date! invalid_reason""",
    "vocabulary": """vocabulary_id! vocabulary_name! vocabulary_reference! vocabulary_version
        vocabulary_concept_id!""",
    "domain": "domain_id! domain_name! domain_concept_id!",
    "concept_class": "concept_class_id! concept_class_name! concept_class_concept_id!",
    "concept_relationship": """concept_id_1! concept_id_2! relationship_id! valid_start_date!
        valid_end_date! invalid_reason""",
    "relationship": """relationship_id! relationship_name! is_hierarchical! defines_ancestry!
        reverse_relationship_id! relationship_concept_id!""",
    "concept_synonym": "concept_id! concept_synonym_name! language_concept_id!",
    "concept_ancestor": """ancestor_concept_id! descendant_concept_id! min_levels_of_separation!
        max_levels_of_separation!""",
    "source_to_concept_map": """source_code! source_concept_id! source_vocabulary_id!
        source_code_description target_concept_id! target_vocabulary_id! valid_start_date!
        valid_end_date! invalid_reason""",
    "drug_strength": """drug_concept_id! ingredient_concept_id! amount_value amount_unit_concept_id
        numerator_value numerator_unit_concept_id denominator_value denominator_unit_concept_id
        box_size valid_start_date! valid_end_date! invalid_reason""",
}

_CDM = {
    "person": """person_id! gender_concept_id! year_of_birth! month_of_birth day_of_birth birth_datetime
        race_concept_id! ethnicity_concept_id! location_id provider_id care_site_id person_source_value
        gender_source_value gender_source_concept_id race_source_value race_source_concept_id
        ethnicity_source_value ethnicity_source_concept_id""",
    "observation_period": """observation_period_id! person_id! observation_period_start_date!
        observation_period_end_date! period_type_concept_id!""",
    "visit_occurrence": """visit_occurrence_id! person_id! visit_concept_id! visit_start_date!
        visit_start_datetime visit_end_date! visit_end_datetime visit_type_concept_id! provider_id
        care_site_id visit_source_value visit_source_concept_id admitting_source_concept_id
        admitting_source_value discharge_to_concept_id discharge_to_source_value
        preceding_visit_occurrence_id""",
    "visit_detail": """visit_detail_id! person_id! visit_detail_concept_id! visit_detail_start_date!
        visit_detail_start_datetime visit_detail_end_date! visit_detail_end_datetime
        visit_detail_type_concept_id! provider_id care_site_id visit_detail_source_value
        visit_detail_source_concept_id admitting_source_value admitting_source_concept_id
        discharge_to_source_value discharge_to_concept_id preceding_visit_detail_id
        visit_detail_parent_id visit_occurrence_id!""",
    "condition_occurrence": """condition_occurrence_id! person_id! condition_concept_id!
        condition_start_date! condition_start_datetime condition_end_date condition_end_datetime
        condition_type_concept_id! condition_status_concept_id stop_reason provider_id
        visit_occurrence_id visit_detail_id condition_source_value condition_source_concept_id
        condition_status_source_value""",
    "drug_exposure": """drug_exposure_id! person_id! drug_concept_id! drug_exposure_start_date!
        drug_exposure_start_datetime drug_exposure_end_date! drug_exposure_end_datetime
        verbatim_end_date drug_type_concept_id! stop_reason refills quantity days_supply sig
        route_concept_id lot_number provider_id visit_occurrence_id visit_detail_id drug_source_value
        drug_source_concept_id route_source_value dose_unit_source_value""",
    "procedure_occurrence": """procedure_occurrence_id! person_id! procedure_concept_id!
        procedure_date! procedure_datetime procedure_type_concept_id! modifier_concept_id quantity
        provider_id visit_occurrence_id visit_detail_id procedure_source_value
        procedure_source_concept_id modifier_source_value""",
    "device_exposure": """device_exposure_id! person_id! device_concept_id! device_exposure_start_date!
        device_exposure_start_datetime device_exposure_end_date device_exposure_end_datetime
        device_type_concept_id! unique_device_id quantity provider_id visit_occurrence_id
        visit_detail_id device_source_value device_source_concept_id""",
    "measurement": """measurement_id! person_id! measurement_concept_id! measurement_date!
        measurement_datetime measurement_time measurement_type_concept_id! operator_concept_id
        value_as_number value_as_concept_id unit_concept_id range_low range_high provider_id
        visit_occurrence_id visit_detail_id measurement_source_value measurement_source_concept_id
        unit_source_value value_source_value""",
    "observation": """observation_id! person_id! observation_concept_id! observation_date!
        observation_datetime observation_type_concept_id! value_as_number value_as_string
        value_as_concept_id qualifier_concept_id unit_concept_id provider_id visit_occurrence_id
        visit_detail_id observation_source_value observation_source_concept_id unit_source_value
        qualifier_source_value""",
    "death": """person_id! death_date! death_datetime death_type_concept_id cause_concept_id
        cause_source_value cause_source_concept_id""",
    "note": """note_id! person_id! note_date! note_datetime note_type_concept_id! note_class_concept_id!
        note_title note_text! encoding_concept_id! language_concept_id! provider_id
        visit_occurrence_id visit_detail_id note_source_value""",
    "note_nlp": """note_nlp_id! note_id! section_concept_id snippet offset lexical_variant!
        note_nlp_concept_id note_nlp_source_concept_id nlp_system nlp_date! nlp_datetime term_exists
        term_temporal term_modifiers""",
    "specimen": """specimen_id! person_id! specimen_concept_id! specimen_type_concept_id! specimen_date!
        specimen_datetime quantity unit_concept_id anatomic_site_concept_id disease_status_concept_id
        specimen_source_id specimen_source_value unit_source_value anatomic_site_source_value
        disease_status_source_value""",
    "fact_relationship": """domain_concept_id_1! fact_id_1! domain_concept_id_2! fact_id_2!
        relationship_concept_id!""",
    "location": "location_id! address_1 address_2 city state zip county location_source_value",
    "care_site": """care_site_id! care_site_name place_of_service_concept_id location_id
        care_site_source_value place_of_service_source_value""",
    "provider": """provider_id! provider_name npi dea specialty_concept_id care_site_id year_of_birth
        gender_concept_id provider_source_value specialty_source_value specialty_source_concept_id
        gender_source_value gender_source_concept_id""",
    "payer_plan_period": """payer_plan_period_id! person_id! payer_plan_period_start_date!
        payer_plan_period_end_date! payer_concept_id payer_source_value payer_source_concept_id
        plan_concept_id plan_source_value plan_source_concept_id sponsor_concept_id
        sponsor_source_value sponsor_source_concept_id family_source_value stop_reason_concept_id
        stop_reason_source_value stop_reason_source_concept_id""",
    "cost": """cost_id! cost_event_id! cost_domain_id! cost_type_concept_id! currency_concept_id
        total_charge total_cost total_paid paid_by_payer paid_by_patient paid_patient_copay
        paid_patient_coinsurance paid_patient_deductible paid_by_primary paid_ingredient_cost
        paid_dispensing_fee payer_plan_period_id amount_allowed revenue_code_concept_id
        revenue_code_source_value drg_concept_id drg_source_value""",
    "drug_era": """drug_era_id! person_id! drug_concept_id! drug_era_start_date! drug_era_end_date!
        drug_exposure_count gap_days""",
    "dose_era": """dose_era_id! person_id! drug_concept_id! unit_concept_id! dose_value!
        dose_era_start_date! dose_era_end_date!""",
    "condition_era": """condition_era_id! person_id! condition_concept_id! condition_era_start_date!
        condition_era_end_date! condition_occurrence_count""",
    "metadata": """metadata_concept_id! metadata_type_concept_id! name! value_as_string
        value_as_concept_id metadata_date metadata_datetime""",
    "cdm_source": """cdm_source_name! cdm_source_abbreviation cdm_holder source_description
        source_documentation_reference cdm_etl_reference source_release_date cdm_release_date
        cdm_version vocabulary_version""",
    "cohort_definition": """cohort_definition_id! cohort_definition_name! cohort_definition_description
        definition_type_concept_id! cohort_definition_syntax subject_concept_id!
        cohort_initiation_date""",
    "attribute_definition": """attribute_definition_id! attribute_name! attribute_description
        attribute_type_concept_id! attribute_syntax""",
}

# Column names of the simulator's CSV export, lower-cased.
_SOURCE = {
    "allergies": """start stop patient encounter code system description type category reaction1
        description1 severity1 reaction2 description2 severity2""",
    "careplans": "id start stop patient encounter code description reasoncode reasondescription",
    "conditions": "start stop patient encounter code description",
    "encounters": """id start stop patient organization provider payer encounterclass code description
        base_encounter_cost total_claim_cost payer_coverage reasoncode reasondescription""",
    "immunizations": "date patient encounter code description base_cost",
    "imaging_studies": """id date patient encounter series_uid bodysite_code bodysite_description
        modality_code modality_description instance_uid sop_code sop_description procedure_code""",
    "medications": """start stop patient payer encounter code description base_cost payer_coverage
        dispenses totalcost reasoncode reasondescription""",
    "observations": "date patient encounter category code description value units type",
    "organizations": "id name address city state zip lat lon phone revenue utilization",
    "patients": """id birthdate deathdate ssn drivers passport prefix first last suffix maiden marital
        race ethnicity gender birthplace address city state county zip lat lon healthcare_expenses
        healthcare_coverage income""",
    "procedures": "start stop patient encounter code description base_cost reasoncode reasondescription",
    "providers": "id organization name gender speciality address city state zip lat lon utilization",
    "devices": "start stop patient encounter code description udi",
    "claims": """id patientid providerid primarypatientinsuranceid secondarypatientinsuranceid
        departmentid patientdepartmentid diagnosis1 diagnosis2 diagnosis3 diagnosis4 diagnosis5
        diagnosis6 diagnosis7 diagnosis8 referringproviderid appointmentid currentillnessdate
        servicedate supervisingproviderid status1 status2 statusp outstanding1 outstanding2
        outstandingp lastbilleddate1 lastbilleddate2 lastbilleddatep healthcareclaimtypeid1
        healthcareclaimtypeid2""",
    "claims_transactions": """id claimid chargeid patientid type amount method fromdate todate
        placeofservice procedurecode modifier1 modifier2 diagnosisref1 diagnosisref2 diagnosisref3
        diagnosisref4 units departmentid notes unitamount transferoutid transfertype payments
        adjustments transfers outstanding appointmentid linenote patientinsuranceid feescheduleid
        providerid supervisingproviderid""",
    "payer_transitions": """patient memberid start_year end_year payer secondary_payer ownership
        ownername""",
    "payers": """id name address city state_headquartered zip phone amount_covered amount_uncovered
        revenue covered_encounters uncovered_encounters covered_medications uncovered_medications
        covered_procedures uncovered_procedures covered_immunizations uncovered_immunizations
        unique_customers qols_avg member_months""",
    "supplies": "date patient encounter code description quantity",
}

_TEXT_IDS = {
    "domain_id", "vocabulary_id", "concept_class_id", "relationship_id", "reverse_relationship_id",
    "cost_domain_id", "unique_device_id", "specimen_source_id", "source_vocabulary_id",
    "target_vocabulary_id",
}
_COUNTS = {
    "year_of_birth", "month_of_birth", "day_of_birth", "refills", "days_supply",
    "drug_exposure_count", "gap_days", "condition_occurrence_count", "box_size",
    "min_levels_of_separation", "max_levels_of_separation",
}
_AMOUNTS = {
    "value_as_number", "range_low", "range_high", "dose_value", "amount_value", "denominator_value",
    "total_charge", "total_cost", "total_paid", "paid_by_payer", "paid_by_patient",
    "paid_patient_copay", "paid_patient_coinsurance", "paid_patient_deductible", "paid_by_primary",
    "paid_ingredient_cost", "paid_dispensing_fee", "amount_allowed",
}
_SOURCE_DATES = {
    "birthdate", "deathdate", "start_year", "end_year", "fromdate", "todate", "lastbilleddate1",
    "lastbilleddate2", "lastbilleddatep",
}
_SOURCE_STAMPS = {"start", "stop", "date", "currentillnessdate", "servicedate"}
_SOURCE_DAY_TABLES = {"allergies", "careplans", "conditions"}  # start and stop hold plain dates
_SOURCE_AMOUNTS = {
    "base_cost", "base_encounter_cost", "total_claim_cost", "payer_coverage", "totalcost", "revenue",
    "healthcare_expenses", "healthcare_coverage", "income", "amount_covered", "amount_uncovered",
    "amount", "unitamount", "payments", "adjustments", "transfers", "outstanding", "outstanding1",
    "outstanding2", "outstandingp", "quantity", "chargeid", "feescheduleid", "transferoutid",
    "diagnosisref1", "diagnosisref2", "diagnosisref3", "diagnosisref4", "healthcareclaimtypeid1",
    "healthcareclaimtypeid2",
}
_SOURCE_COUNTS = {"dispenses", "unique_customers", "member_months", "utilization"}


def _target_type(table: str, column: str, id_type: T.DataType) -> T.DataType:
    if column == "numerator_value":
        return WIDE_NUMERIC
    if column == "quantity":
        return NUMERIC if table in ("drug_exposure", "specimen") else INT
    if column in _AMOUNTS:
        return NUMERIC
    if column in _COUNTS:
        return INT
    if table == "fact_relationship":
        return LONG if column == "relationship_concept_id" else INT
    if column in _TEXT_IDS:
        return TEXT
    if column.endswith(("_id", "_id_1", "_id_2")):
        return id_type
    if column.endswith("_datetime"):
        return STAMP
    if column.endswith("_date"):
        return DATE
    return TEXT


def _source_type(table: str, column: str) -> T.DataType:
    if column in ("start", "stop") and table in _SOURCE_DAY_TABLES:
        return DATE
    if column in _SOURCE_STAMPS:
        return STAMP
    if column in _SOURCE_DATES:
        return DATE
    if column in ("lat", "lon", "qols_avg"):
        return REAL
    if column == "units" and table == "claims_transactions":
        return NUMERIC
    if column in _SOURCE_AMOUNTS:
        return NUMERIC
    if column in _SOURCE_COUNTS or column.startswith(("covered_", "uncovered_")):
        return INT
    return TEXT


def _build(layout: str, type_of) -> T.StructType:
    fields = []
    for word in layout.split():
        name = word.rstrip("!")
        fields.append(T.StructField(name, type_of(name), nullable=not word.endswith("!")))
    return T.StructType(fields)


VOCABULARY = {t: _build(s, lambda c, t=t: _target_type(t, c, INT)) for t, s in _VOCABULARY.items()}
CDM = {t: _build(s, lambda c, t=t: _target_type(t, c, LONG)) for t, s in _CDM.items()}
SOURCE = {t: _build(s, lambda c, t=t: _source_type(t, c)) for t, s in _SOURCE.items()}


def required_columns(schema: T.StructType) -> list[str]:
    """Names of the columns that must not be NULL."""
    return [f.name for f in schema.fields if not f.nullable]
