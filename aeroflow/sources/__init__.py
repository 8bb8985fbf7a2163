"""Where messages and tables come from.

Every message source gives the columns of ``schemas.MESSAGE_FIELDS``.
"""
