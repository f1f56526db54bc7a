"""Exam microdata lakehouse: bronze schema and job (M09), staging (M05),
marts (M06–M08), ad-hoc reports (M01–M04) and their code books."""
