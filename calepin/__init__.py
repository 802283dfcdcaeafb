"""Appointment and opening-slot analytics expressed as Spark DataFrame jobs."""
