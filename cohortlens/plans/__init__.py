"""Named query catalogue, its SQL checks, and the end-to-end survey job."""
