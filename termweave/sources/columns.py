"""Names of CRM columns that several plans share."""

# Column names of the CRM mart, part of the import contract.
STATUS_CODE = "college_track_status_c"
STATUS_NAME = "College_Track_Status_Name"

# Columns of a term that are joined to students and feed rows.
TERM_COLUMNS = [
    "GAS_id",
    "GAS_Name",
    "GAS_Name_short",
    "academic_year_c",
    "term_c",
    "academic_calendar_category_c",
    "GAS_start_date",
    "GAS_end_date",
]

#: The student's key in tables that are laid out by it.
STUDENT_KEY = "_student_key"

#: The part of a table that is staged by student.
STUDENT_PART = "_student_part"
