"""From bronze rows to the star schema, the marts and the questions they answer."""
